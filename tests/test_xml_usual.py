"""Usual documents are told by pattern, and read as the parser reads them."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from folioflow.plans.ingest import staged_documents
from folioflow.sources import xml_documents as xml
from folioflow.sources import xml_usual

HEAD = "<Encabezado><IdDoc><TipoDTE>33</TipoDTE><Folio> 7 </Folio><FchEmis>2024-1-5</FchEmis></IdDoc><Emisor><RUTEmisor>1-9</RUTEmisor><RznSoc>Peña</RznSoc></Emisor></Encabezado>"
LINE = "<Detalle><NroLinDet>1</NroLinDet><CdgItem><TpoCodigo>INT</TpoCodigo><VlrCodigo>a</VlrCodigo></CdgItem><NmbItem>x y</NmbItem><QtyItem>2</QtyItem><MontoItem>9</MontoItem></Detalle>"
DOC = f'<Documento ID="D">{HEAD}{LINE}</Documento>'
USUAL = [
    DOC, f"<DTE>{DOC}</DTE>", f'<?xml version="1.0"?>\n<A x="1"><B>\n <DTE> {DOC} </DTE></B>\n</A>\n', f"<DTE><!-- <Documento> -->{DOC}</DTE>",
    DOC.replace("</", "</sii:").replace("<", "<sii:").replace("<sii:/sii:", "</sii:"), f"<Documento>{LINE}</Documento>", f"<Documento>{HEAD}</Documento>",
    DOC.replace("<Folio> 7 </Folio>", "<Folio>8</Folio><Otro>1</Otro><Folio>9</Folio><IndServicio>3</IndServicio>"), f"<Documento>{HEAD}{LINE}\n{LINE}<TmstFirma>t</TmstFirma></Documento>",
    DOC.replace("<RUTEmisor>1-9</RUTEmisor>", "<RUTEmisor></RUTEmisor>"), "<Documento></Documento>",
    DOC.replace("</CdgItem>", "</CdgItem><CdgItem><TpoCodigo>EAN</TpoCodigo></CdgItem>"),
]
OTHER = [
    DOC.replace("x y", "x &amp; y"), DOC.replace("x y", "x\ty"), DOC.replace("x y", "x "), DOC.replace("x y", "€"), DOC.replace("x y", "<![CDATA[x]]>"), DOC.replace("x y", "x & y"),
    DOC.replace("x y", "x\x01y"), "\x01" + DOC, "\x01E" + DOC, DOC.replace("<Folio> 7 </Folio>", "<folio>8</folio>"), DOC.replace("<Folio>", '<Folio a="1">'), DOC.replace("x y", "x<b/>y"),
    DOC.replace("</NmbItem>", "</NmbIte>"), DOC[:-12], DOC + "<extra/>", DOC + DOC, f"<DTE>{DOC}", f"<DTE>{DOC}</DT>", f"<A><B>{DOC}</A>", f"<A>{DOC}</B></A>", f"{DOC}</A>", f"<DTE>{DOC}{DOC}</DTE>", f"<DTE>text{DOC}</DTE>",
    DOC.replace("</Encabezado>", "</Encabezado><Encabezado></Encabezado>"), DOC.replace("</Emisor>", "</Emisor><Emisor><RznSoc>Dos</RznSoc></Emisor>"),
    DOC.replace("</Detalle>", "<CdgItem><VlrCodigo>b</VlrCodigo></CdgItem></Detalle>"), DOC.replace("<CdgItem>", "<CdgItem>text"), DOC.replace(LINE, "<Detalle>" + LINE + "</Detalle>"),
    "<Documento><Encabezado></Encabezado></Documento>", "<Documento/>", "", DOC.replace(LINE, "<Referencia><N>1</N></Referencia>" + LINE), f"<Documento>{LINE}{HEAD}</Documento>",
    DOC.replace("<NroLinDet>1</NroLinDet>", "").replace("<NmbItem>", "<NroLinDet>4</NroLinDet><NmbItem>"), DOC.replace("<MontoItem>9", "<Documento>9</Documento><MontoItem>9"),
]


def _files(spark, texts):
    return spark.createDataFrame([(f"f{i:03}", t) for i, t in enumerate(texts)], "file string, text string")


def _read(files):
    pieces = xml.whole_file_documents(files)
    strict = staged_documents(pieces).drop("shape").withColumn("lines", F.to_json("lines")).collect()
    tolerant = xml.tolerant_documents(pieces, date(2024, 1, 1)).withColumn("lines", F.to_json("lines")).collect()
    return sorted(map(str, strict)), sorted(map(str, tolerant))


def test_usual_files_are_told_by_pattern(spark):
    told = xml_usual.told(_files(spark, USUAL), xml_usual.FILE)
    assert [r.text for r in told.filter("_head IS NULL").collect()] == []


@pytest.mark.parametrize("texts", [USUAL, OTHER])
def test_same_rows_as_the_parser(spark, monkeypatch, texts):
    files = _files(spark, texts)
    by_pattern = _read(files)
    for name in ("FILE", "DOCUMENT"):
        monkeypatch.setattr(xml_usual, name, "(?!)")
    assert by_pattern == _read(files)


def test_usual_pieces_have_the_same_shape(spark, monkeypatch, tmp_path):
    for i, text in enumerate([f"<A><B>{DOC}</B>\n<B>{DOC}</B><C k='1'>{DOC}</C></A>", f"<A><B>{DOC}</B><B>{DOC}</A>", f"<A>{DOC}{DOC}</A><A/>", f'<?xml version="1.0"?>\n<A x="1"> <B>{DOC}</B> </A>',
                              f"<A><B>{DOC}</B>x<B>{DOC}</B></A>", f"<?xml version='1.0' encoding='ISO-8859-1'?><A>{DOC}</A>"]):
        (tmp_path / f"{i}.xml").write_bytes(text.encode("ISO-8859-1" if "8859" in text else "UTF-8"))

    def read():
        pieces = xml.scan_documents(spark, str(tmp_path), whole_file_bytes=1)
        return sorted(map(str, xml.file_verdicts(pieces).collect())), sorted(map(str, xml.parsed_documents(pieces).drop("position").collect()))

    by_pattern = read()
    assert [("malformed=True" in v) for v in by_pattern[0]] == [False, True, True, False, False, False]
    for name in ("PIECE", "DOCUMENT"):
        monkeypatch.setattr(xml_usual, name, "(?!)")
    assert by_pattern == read()
