import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from folioflow.sources import xml_documents as xml
from samples import BARE, FAULTY, NS, VALID, document, envelope, line, prefixed


def scan(spark, folder, whole=1 << 20):
    return xml.scan_documents(spark, str(folder), whole_file_bytes=whole)


def by_folio(df):
    return {r.folio: r for r in df.collect()}


def test_same_rows_for_every_envelope(spark, folder):
    d = document(1, [line()])
    shapes = {
        "envelope": envelope(d), "prefixed": prefixed(envelope(d)), "dte": f"<DTE>{d}</DTE>", "bare": document(1, [line()], attr=""),
        "no_namespace": envelope(d, ns=""), "comment": f"<!-- first --><DTE><!-- <x> -->{d}</DTE><!-- last -->\n",
        "direct": f"<EnvioDTE><DTE>{d}</DTE></EnvioDTE>", "set": f"<SetDTE xmlns='{NS}'>{d}</SetDTE>".replace("SetDTE", "SetDTE"),
    }
    for name, text in shapes.items():
        (folder / f"{name}.xml").write_text(text, encoding="utf-8")
    for whole in (1 << 20, 1):
        rows = xml.parsed_documents(scan(spark, folder, whole)).select(xml.file_name(F.col("file")).alias("f"), "header_id", "mnt_total", "lines").collect()
        assert {r.f for r in rows} == {f"{n}.xml" for n in shapes}
        assert {(r.header_id, r.mnt_total, len(r.lines)) for r in rows} == {("33:1:11111111-1", D("119.00"), 1)}


def test_values_and_fallbacks(spark, folder):
    code = "<CdgItem><TpoCodigo>INT1</TpoCodigo><VlrCodigo>60AR1</VlrCodigo></CdgItem><CdgItem><VlrCodigo>second</VlrCodigo></CdgItem>"
    docs = [
        document(1, [line(1, "A", "3", None, 100, code), line(2, "B", None, "30", 100, "<DscItem>Long B</DscItem>"), line(3, "C", None, None, 5),
                     line(4, "D", "0", None, 5), line("x", None, "1", "1", "1.5")]),
        document(2, [], issuer_name="<RznSocEmisor></RznSocEmisor><RznSoc>Second SA</RznSoc>", receiver_name="<RznSoc>Third</RznSoc>", day="2025-02-30"),
        document(3, [], issuer_name="<RznSocEmisor>First</RznSocEmisor><RznSoc>Second SA</RznSoc>", total=" 119 ", net="1190.50"),
    ]
    (folder / "a.xml").write_text(envelope(*docs))
    heads = by_folio(xml.parsed_documents(scan(spark, folder)))
    assert (heads[2].razon_social_emisor, heads[2].razon_social_receptor, heads[2].fecha_emision) == ("Second SA", "Third", None)
    assert (heads[3].razon_social_emisor, heads[3].mnt_total, heads[3].mnt_neto) == ("First", D("119.00"), None)
    assert heads[3].iva == D("19.00"), "the tax, not the tax rate"
    got = [tuple(l) for l in heads[1].lines]
    six = lambda v: None if v is None else D(v).quantize(D("1.000000"))
    assert got[0] == (1, "INT1", "A", "60AR1", "A", six("3"), six("33.33"), D("100.00"))
    assert got[1] == (2, None, "B", None, "Long B", six("3.333333"), six("30"), D("100.00"))
    assert got[2][5:7] == (None, None)
    assert got[3][5:7] == (six("0"), None)
    assert got[4][0] is None and got[4][2] is None and got[4][7] is None


def test_encodings(spark, folder):
    (folder / "latin.xml").write_bytes(BARE.encode("latin-1"))
    (folder / "utf8.xml").write_bytes("﻿".encode() + document(2, [line(1, "Ñandú")], attr="").encode())
    (folder / "utf16.xml").write_bytes(('<?xml version="1.0" encoding="UTF-16"?>' + document(3, [line()], attr="", name="Ü")).encode("utf-16"))
    (folder / "wrong.xml").write_bytes(document(4, [line(1, "Ñ")], attr="").encode("latin-1"))
    heads = by_folio(xml.parsed_documents(scan(spark, folder)))
    assert heads[1001].lines[0].nombre_item == "Ítem Ñ"
    assert heads[2].lines[0].nombre_item == "Ñandú"
    assert 4 not in heads, "bytes that do not fit the declared encoding fail the file"
    split = by_folio(xml.parsed_documents(scan(spark, folder, 1).filter(~F.col("file").contains("utf16"))))
    assert split[1001].lines[0].nombre_item == "Ítem Ñ" and split[2].lines[0].nombre_item == "Ñandú"


@pytest.mark.parametrize("whole", [1 << 20, 1])
def test_one_bad_byte_fails_the_file(spark, folder, whole):
    good = envelope(document(1, [line()]), document(2, [line()]))
    (folder / "good.XML").write_text(good)
    (folder / "cut.xml").write_text(good[:-20])
    (folder / "cut_inside.xml").write_text(good[:-300])
    (folder / "broken.xml").write_text(good.replace("<Folio>2", "<Folia>2"))
    (folder / "empty.xml").write_text("<nothing/>")
    (folder / "other.txt").write_text(good)
    pieces = scan(spark, folder, whole)
    verdicts = {r.file.rsplit("/", 1)[1]: r.malformed for r in xml.file_verdicts(pieces).collect()}
    assert verdicts == {"good.XML": False, "cut.xml": True, "cut_inside.xml": True, "broken.xml": True, "empty.xml": False}
    kept = xml.parsed_documents(xml.sound_documents(pieces))
    assert sorted(r.folio for r in kept.collect()) == [1, 2]


def test_whole_files_must_close_one_root(spark):
    d = document(1, [line()], attr="")
    texts = {"ok": d, "junk": d + "junk", "two": d + d, "text": "not xml", "blank": "", "lead": "  \n" + d + "\n<!-- end -->"}
    files = spark.createDataFrame(list(texts.items()), "file string, text string")
    got = {r.file: r.malformed for r in xml.file_verdicts(xml.whole_file_documents(files)).collect()}
    assert got == {"ok": False, "junk": True, "two": True, "text": True, "blank": True, "lead": False}


def test_large_files_are_shared_by_tasks(spark, folder):
    docs = [document(i, [line(1, f"Item {i}")]) for i in range(400)]
    (folder / "big.xml").write_text(envelope(*docs))
    (folder / "plain.xml").write_text(envelope(*[document(1000 + i, [line()], attr="") for i in range(100)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        pieces = scan(spark, folder, 1)
        assert pieces.filter(F.col("file").contains("big")).select("position.block").distinct().count() > 5
        split = xml.parsed_documents(xml.sound_documents(pieces))
        assert split.count() == 500
        ordered = [r.folio for r in split.filter("folio < 1000").orderBy("file", "position").collect()]
        assert ordered == list(range(400)), "positions follow the file"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = xml.parsed_documents(scan(spark, folder))
    assert split.drop("file", "position").exceptAll(whole.drop("file", "position")).count() == 0


def test_documents_without_header_are_skipped(spark, folder):
    (folder / "a.xml").write_text(envelope("<Documento><Detalle><NroLinDet>1</NroLinDet></Detalle></Documento>", document(7, [line()])))
    assert [r.folio for r in xml.parsed_documents(scan(spark, folder)).collect()] == [7]


def test_filters_do_not_parse_again(spark, folder):
    (folder / "a.xml").write_text(VALID)
    files = xml.xml_files(spark, str(folder)).select("file", xml.decoded(F.col("content")).alias("text"))
    found = xml.parsed_documents(xml.whole_file_documents(files)).filter("folio = 10001 AND mnt_total > 0")
    assert found._jdf.queryExecution().executedPlan().toString().count("from_xml(") == 1


def test_tolerant_reading(spark, folder):
    text = ("<DTE><Documento><Encabezado><IdDoc><TipoDTE>39</TipoDTE><FechaEmision>2025-03-01</FechaEmision></IdDoc><Totales><TasaIVA>19</TasaIVA>"
            "<IVA>4,5</IVA></Totales></Encabezado><Detalle><CdgItem>X<VlrCodigo>77</VlrCodigo></CdgItem><QtyItem>1,25</QtyItem></Detalle>"
            "<Detalle><CdgItem><VlrCodigo>88</VlrCodigo></CdgItem></Detalle><Detalle/></Documento></DTE>")
    (folder / "a.xml").write_text(text)
    row = xml.tolerant_documents(scan(spark, folder), dt.date(2024, 1, 1)).first()
    assert (row.tipo_dte, row.folio, row.fecha_emision, row.rut_emisor) == ("39", "", dt.date(2025, 3, 1), "")
    assert (row.iva, row.mnt_total) == (D("4.5"), D(0))
    assert [l.codigo for l in row.lines] == ["X:77", ":88", None]
    assert row.lines[0].cantidad == D("1.25") and row.lines[2].n_linea == 0


def test_xsd(spark, folder, tmp_path):
    schema = tmp_path / "dte.xsd"
    schema.write_text('<?xml version="1.0"?><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="EnvioDTE"><xs:complexType>'
                      '<xs:sequence><xs:element name="n" type="xs:int"/></xs:sequence><xs:anyAttribute processContents="skip"/></xs:complexType></xs:element></xs:schema>')
    head = '<EnvioDTE note="EnvioDTE_v10.xsd">'
    files = spark.createDataFrame([("ok", head + "<n>1</n></EnvioDTE>"), ("bad", head + "<n>x</n></EnvioDTE>"),
                                   ("none", "<EnvioDTE><n>x</n></EnvioDTE>")], "file string, text string")
    bad = xml.xsd_invalid(files, {"dte": str(schema)})
    assert [(r.file, r.kind) for r in bad.collect()] == [("bad", "dte")]
    kinds = spark.createDataFrame([("a EnvioBOLETA_v11.xsd EnvioDTE_v10.xsd",), (" " * 4096 + "EnvioDTE_v10.xsd",)], "t string")
    assert [r[0] for r in kinds.select(xml.xsd_kind(F.col("t"))).collect()] == ["boleta", None]


def test_unseen_files(spark):
    files = spark.createDataFrame([("/in/a.xml",), ("/in/b.xml",), ("/in/c.xml",), ("/in/x/a.xml",)], "file string")
    registry = spark.createDataFrame([("/in/a.xml", "OK"), ("/in/b.xml", "FAILED")], "file_id string, status string")
    assert {r.file for r in xml.unseen(files, registry).collect()} == {"/in/c.xml", "/in/x/a.xml"}
    assert {r.file for r in xml.unseen(files, registry, retry_failed=True).collect()} == {"/in/b.xml", "/in/c.xml", "/in/x/a.xml"}
