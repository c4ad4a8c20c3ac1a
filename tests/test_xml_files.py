"""One meaning for a file however it is read: the standard library's parser tells what is well-formed and what the values are."""

from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from folioflow.sources import xml_documents as xml
from folioflow.sources import xml_text
from samples import document, envelope, line


def doc(folio, name="EMISOR SA", **more):
    return document(folio, [line()], name=name, **more)


def encoded(text, charset, named=None):
    return f'<?xml version="1.0" encoding="{named or charset}"?>\n{text}'.encode(charset)


ENTITY = '<!DOCTYPE EnvioDTE [<!ENTITY firma "SOC &amp; HIJOS"><!ENTITY n "&firma; LTDA">]>\n'
PLAIN = envelope(doc(1), doc(2))

FILES = {
    "deep": f"<Env><Body><EnvioDTE><SetDTE><DTE>{doc(1)}</DTE></SetDTE></EnvioDTE></Body></Env>".encode(),
    "two_roots_blank": f"<DTE>{doc(1)}</DTE ><DTE>{doc(2)}</DTE>".encode(),
    "two_roots": f"<DTE>{doc(1)}</DTE><DTE>{doc(2)}</DTE>".encode(),
    "utf16": encoded(envelope(doc(1, "Peña €"), prolog=""), "utf-16"),
    "utf16be": "﻿".encode("utf-16-be") + encoded(envelope(doc(1, "Peña 😀"), prolog=""), "utf-16-be", "UTF-16"),
    "utf16_lost_half": encoded(envelope(doc(1, "PeXa"), prolog=""), "utf-16").replace("X".encode("utf-16-le"), b"\x00\xd8"),
    "cp1252": encoded(envelope(doc(1, "Peña €"), prolog=""), "windows-1252"),
    "cp1252_no_letter": encoded(envelope(doc(1, "PeXa"), prolog=""), "windows-1252").replace(b"X", b"\x81"),
    "latin1": encoded(envelope(doc(1, "Ã±"), prolog=""), "ISO-8859-1"),
    "latin9": encoded(envelope(doc(1, "Peña €"), prolog=""), "ISO-8859-15"),
    "koi8": encoded(envelope(doc(1, "Пенья"), prolog=""), "KOI8-R"),
    "utf8_invalid": encoded(envelope(doc(1, "PeXa"), prolog=""), "UTF-8").replace(b"X", b"\xf1"),
    "utf8_mark": "﻿".encode() + envelope(doc(1, "Peña")).encode(),
    "unnamed_invalid": envelope(doc(1, "PeXa"), prolog="").encode().replace(b"X", b"\xf1"),
    "not_utf16": envelope(doc(1), prolog='<?xml version="1.0" encoding="UTF-16"?>').encode(),
    "unknown_charset": envelope(doc(1), prolog='<?xml version="1.0" encoding="x-none"?>').encode(),
    "entity": (ENTITY + envelope(doc(1, "&firma;"), doc(2, "&n;"), prolog="")).encode(),
    "unknown_entity": envelope(doc(1, "&firma;")).encode(),
    "references": envelope(doc(1, "Pe&#241;a &amp; &#x48;ijos")).encode(),
    "comment_closes_root": PLAIN.replace("</SetDTE>", "<!-- </SetDTE></EnvioDTE> --></SetDTE>").encode(),
    "comment_closes_document": envelope(doc(1).replace("<Detalle>", "<!-- </Documento> <Documento> --><Detalle>"), doc(2)).encode(),
    "comment_over_documents": PLAIN.replace("</Caratula>", f"</Caratula><!-- {doc(8)}{doc(9)} -->").encode(),
    "comment_open": PLAIN.replace("</Caratula>", "</Caratula><!-- ").encode(),
    "comment_dashes": PLAIN.replace("</Caratula>", "</Caratula><!-- a -- b -->").encode(),
    "section": envelope(doc(1, "<![CDATA[A <&> </Documento>]]> B"), doc(2, "<![CDATA[C & D]]>")).encode(),
    "section_open": envelope(doc(1, "<![CDATA[A")).encode(),
    "instructions": PLAIN.replace("<DTE", "<?mark <Documento> ?><DTE", 1).encode(),
    "prolog_late": ("\n" + PLAIN).encode(),
    "prolog_twice": PLAIN.replace("</Caratula>", '</Caratula><?xml version="1.0"?>').encode(),
    "tail": (PLAIN + "<!-- end -->\n").encode(),
    "text_after": (PLAIN + "end").encode(),
    "text_before": ("start" + envelope(doc(1), prolog="")).encode(),
    "inner_tag": envelope(doc(1).replace("<Detalle>", "<TipoDocumento>33</TipoDocumento><Detalle>"), doc(2)).encode(),
    "crossed": PLAIN.replace("</SetDTE></EnvioDTE>", "</EnvioDTE></SetDTE>").encode(),
    "crossed_inside": PLAIN.replace("</IdDoc></", "</", 1).encode(),
    "unclosed": PLAIN.replace("</SetDTE>", "").encode(),
    "cut": PLAIN.encode()[:-15],
    "cut_in_tag": PLAIN.encode()[:PLAIN.index("</Documento>") + 2],
    "bare_cut": doc(1, attr="").encode()[:-len("Documento>")],
    "bare": doc(1, attr="").encode(),
    "bare_blank": doc(1, attr="").replace("</Documento>", "</Documento >").encode(),
    "no_space": PLAIN.replace('<SetDTE ID="S">', '<SetDTE ID="S"x="1">').encode(),
    "twice": PLAIN.replace('<SetDTE ID="S">', '<SetDTE ID="S" ID="T">').encode(),
    "ampersand": PLAIN.replace('<SetDTE ID="S">', '<SetDTE ID="A & B">').encode(),
    "greater": PLAIN.replace('<SetDTE ID="S">', '<SetDTE ID="A > B">').encode(),
    "unquoted": PLAIN.replace('<SetDTE ID="S">', "<SetDTE ID=S>").encode(),
    "control": PLAIN.replace("</Caratula>", "\x01</Caratula>").encode(),
    "empty_root": b"<nothing/>",
    "empty": b"",
    "blank": b" \n",
}


def expected(raw):
    """(well-formed, issuers by folio) as the standard library has it."""
    try:
        root = ElementTree.fromstring(raw)
    except (ElementTree.ParseError, ValueError, LookupError):
        return False, {}
    local = lambda e: e.tag.rsplit("}", 1)[-1]
    found = {}
    for d in (e for e in root.iter() if local(e) == "Documento"):
        cells = {local(e): (e.text or "").strip() for e in d.iter()}
        found[int(cells["Folio"])] = cells["RznSoc"]
    return True, found


@pytest.mark.parametrize("whole,split", [(1 << 20, 1 << 20), (1, 1 << 20), (1, 400)])
def test_every_file_reads_alike(spark, folder, whole, split):
    for name, raw in FILES.items():
        (folder / f"{name}.xml").write_bytes(raw)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        pieces = xml.scan_documents(spark, str(folder), whole_file_bytes=whole)
        verdicts = {r.file.rsplit("/", 1)[1][:-4]: not r.malformed for r in xml.file_verdicts(pieces).collect()}
        rows = xml.parsed_documents(xml.sound_documents(pieces)).select(xml.file_name(F.col("file")).alias("f"), "folio", "razon_social_emisor").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = {name: expected(raw) for name, raw in FILES.items()} | {"utf16_lost_half": (False, {})}  # no character, which that parser lets pass
    verdicts.setdefault("empty", False)  # a file without bytes has no row when it is cut into rows
    assert verdicts == {name: good for name, (good, _) in want.items()}
    got = {}
    for r in rows:
        got.setdefault(r.f[:-4], {})[r.folio] = r.razon_social_emisor
    assert got == {name: docs for name, (_, docs) in want.items() if docs}


def test_shapes_join_in_any_grouping(spark):
    """The shape of a text is that of its parts joined, wherever it is cut and however the parts are grouped."""
    texts = ["<a><b><c/></b>x<b/></a>", "<a></a><b></b>", "</a></b><c>", "<a><b></a></b>", "x<a>y</a>z", "", "</b><c/></a><d><e>", "<a/><b/>"]
    rows = []
    for t in texts:
        cuts = [0, *(i for i in range(1, len(t)) if t[i] == "<" or t[i - 1] == ">"), len(t)]
        parts = [t[a:b] for a, b in zip(cuts, cuts[1:])]
        rows += [(t, parts[:i], parts[i:]) for i in range(len(parts) + 1)]
    df = spark.createDataFrame(rows, "t string, a array<string>, b array<string>")
    part = lambda c: xml_text.all_joined(F.transform(c, lambda p: F.struct(xml_text.shape(p).alias("shape"))))
    out = df.select("t", xml_text.shape(F.col("t")).alias("whole"), xml_text.joined(part("a"), part("b")).alias("parts"))
    for r in out.collect():
        assert r.whole.ok == r.parts.ok, r
        if r.whole.ok:
            assert r.whole == r.parts, r
