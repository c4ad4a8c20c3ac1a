"""Registered queries: reading documents from XML, HTML and text.

The given tables hold no tax documents, so Spark writes them: one document per order or per line
item, with the gaps and faults that the parser has to deal with taken from the row's own columns.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import scalars
from folioflow.functions.text_fields import document_type, visible_text
from folioflow.operators.dedupe import split_rejects
from folioflow.plans.registry import query, with_roles
from folioflow.sources import xml_documents as xml
from folioflow.sources.tables import documents, lines, table
from folioflow.sources.text_documents import headers_from_text, plain_text

AS_OF = date(2024, 1, 1)
FLOOR = "CAST(floor({}) AS BIGINT)"


def _tag(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), value.cast("string"), F.lit(f"</{name}>"))


def _maybe(test: Column, text: Column) -> Column:
    return F.when(test, text).otherwise("")


def _whole(c: Column) -> Column:
    return F.floor(c).cast("bigint")


# ---- one document per order

def order_xml(spark, sf) -> DataFrame:
    """(file, text): envelopes in three shapes, with and without prefix, by document type.

    Receipts spell the issuer name in the second tag, credit notes leave an empty first one; orders
    of low priority have no net amount, urgent ones no header. Each has one line; those of credit
    notes carry the gross amount.
    """
    d = documents(spark, sf, parties=True, dealt=True)
    urgency = table(spark, sf, "orders").select(F.col("o_orderkey").alias("header_id"), "o_orderpriority")
    d = d.join(urgency, "header_id")
    tipo = F.col("tipo_dte")
    name = (
        F.when(tipo == 33, _tag("RznSocEmisor", F.col("razon_social_emisor")))
        .when(tipo == 39, _tag("RznSoc", F.col("razon_social_emisor")))
        .otherwise(F.concat(F.lit("<RznSocEmisor></RznSocEmisor>"), _tag("RznSoc", F.col("razon_social_emisor")))))
    net = _maybe(F.col("o_orderpriority") != "5-LOW", _tag("MntNeto", _whole(F.col("mnt_neto"))))
    head = F.concat(
        F.lit("<IdDoc>"), _tag("TipoDTE", tipo), _tag("Folio", F.concat(F.lit(" "), F.col("folio"), F.lit(" "))),
        _tag("FchEmis", F.date_format("fecha_emision", "yyyy-M-d")), F.lit("</IdDoc><Emisor>"),
        _tag("RUTEmisor", F.col("rut_emisor")), name, F.lit("</Emisor><Receptor>"), _tag("RUTRecep", F.col("rut_receptor")),
        _tag("RznSocRecep", F.col("razon_social_receptor")), F.lit("</Receptor><Totales>"), net,
        F.lit("<TasaIVA>19.00</TasaIVA>"), _tag("IVA", _whole(F.col("iva"))), _tag("MntTotal", _whole(F.col("mnt_total"))),
        F.lit("</Totales>"))
    head = _maybe(F.col("o_orderpriority") != "1-URGENT", _tag("Encabezado", head))
    amount = F.when(tipo == 61, F.col("mnt_total")).otherwise(F.col("mnt_neto"))
    line = F.concat(
        _tag("NroLinDet", F.lit(1)), _tag("NmbItem", F.col("o_orderpriority")), _tag("QtyItem", F.lit("1.0")),
        _tag("PrcItem", _whole(F.col("mnt_neto"))), _tag("MontoItem", _whole(amount)))
    doc = F.concat(F.lit('<Documento ID="D">'), head, _tag("Detalle", line), F.lit("</Documento>"))
    ns = ' xmlns="http://www.sii.cl/SiiDte"'
    text = (
        F.when(tipo == 33, F.concat(F.lit(f'<?xml version="1.0"?><EnvioDTE{ns}><SetDTE><DTE>'), doc, F.lit("</DTE></SetDTE></EnvioDTE>")))
        .when(tipo == 39, F.concat(F.lit("<DTE><!-- <Documento> -->"), doc, F.lit("</DTE>")))
        .otherwise(F.regexp_replace(F.regexp_replace(doc, "<(?!/)", "<sii:"), "</", "</sii:")))
    return d.select(F.concat(F.lit("F"), "header_id", F.lit(".xml")).alias("file"), text.alias("text"))


XML_HEADERS = f"""parsed AS (
  SELECT 'F' || header_id || '.xml' AS file, tipo_dte, folio, fecha_emision, rut_emisor, razon_social_emisor, rut_receptor,
    razon_social_receptor, CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN floor(mnt_neto) END AS DECIMAL(18,2)) AS mnt_neto,
    CAST(floor(iva) AS DECIMAL(18,2)) AS iva, CAST(floor(mnt_total) AS DECIMAL(18,2)) AS mnt_total,
    concat_ws(':', tipo_dte, folio, rut_emisor) AS header_id
  FROM docs JOIN (SELECT o_orderkey AS header_id, o_orderpriority FROM orders) USING (header_id) WHERE o_orderpriority <> '1-URGENT')"""


@query("xml_headers", with_roles("docs", "SELECT * FROM parsed", XML_HEADERS))
def xml_headers(spark, sf):
    return xml.parsed_documents(xml.whole_file_documents(order_xml(spark, sf))).drop("position", "lines")


@query("xml_rejects", with_roles("docs", """
  SELECT file, header_id, 'missing mnt_neto' AS reason FROM parsed WHERE mnt_neto IS NULL""", XML_HEADERS))
def xml_rejects(spark, sf):
    parsed = xml.parsed_documents(xml.whole_file_documents(order_xml(spark, sf)))
    return split_rejects(parsed)[1].select("file", "header_id", "reason")


@query("xml_malformed", """
  SELECT 'F' || o_orderkey || '.xml' AS file, o_orderstatus <> 'F' AS malformed FROM orders""")
def xml_malformed(spark, sf):
    """Invoices arrive whole; receipts lose their last bytes and credit notes get junk appended."""
    whole = order_xml(spark, sf)
    envelope = F.col("text").contains("SetDTE")
    cut = F.when(envelope, F.col("text")).when(
        F.col("text").contains("<DTE>"), F.substring("text", F.lit(1), F.length("text") - 9)).otherwise(
        F.concat("text", F.lit("<extra/>")))
    return xml.file_verdicts(xml.whole_file_documents(whole.select("file", cut.alias("text"))))


@query("xml_tolerant", with_roles("docs", """
  SELECT file, tipo_dte, folio, fecha_emision, rut_emisor, rznsoc_emisor, rut_receptor, rznsoc_receptor, mnt_neto, iva, mnt_total FROM (
    SELECT 'F' || header_id || '.xml' AS file, o_orderpriority <> '1-URGENT' AS ok, CASE WHEN ok THEN CAST(tipo_dte AS VARCHAR) ELSE '' END AS tipo_dte,
      CASE WHEN ok THEN CAST(d.folio AS VARCHAR) ELSE '' END AS folio, CASE WHEN ok THEN d.fecha_emision ELSE DATE '2024-01-01' END AS fecha_emision,
      CASE WHEN ok THEN d.rut_emisor ELSE '' END AS rut_emisor, CASE WHEN ok AND d.tipo_dte <> 33 THEN razon_social_emisor ELSE '' END AS rznsoc_emisor,
      CASE WHEN ok THEN d.rut_receptor ELSE '' END AS rut_receptor, CASE WHEN ok THEN razon_social_receptor ELSE '' END AS rznsoc_receptor,
      CAST(CASE WHEN ok AND o_orderpriority <> '5-LOW' THEN floor(d.mnt_neto) ELSE 0 END AS DECIMAL(18,6)) AS mnt_neto,
      CAST(CASE WHEN ok THEN floor(d.iva) ELSE 0 END AS DECIMAL(18,6)) AS iva, CAST(CASE WHEN ok THEN floor(d.mnt_total) ELSE 0 END AS DECIMAL(18,6)) AS mnt_total
    FROM docs d JOIN (SELECT o_orderkey AS header_id, o_orderpriority FROM orders) USING (header_id))"""))
def xml_tolerant(spark, sf):
    """The same files read with defaults for what is missing."""
    pieces = xml.whole_file_documents(order_xml(spark, sf))
    return xml.tolerant_documents(pieces, AS_OF).drop("position", "lines")


@query("xsd_kinds", """
  SELECT CASE o_orderstatus WHEN 'F' THEN 'boleta' WHEN 'O' THEN 'dte' ELSE 'none' END AS kind, count(*) AS n FROM orders GROUP BY 1""")
def xsd_kinds(spark, sf):
    """Schema named by each envelope; one is named too late in the file to count."""
    status = F.col("o_orderstatus")
    pad = F.when(status == "P", F.repeat(F.lit(" "), F.lit(5000))).otherwise("")
    name = F.when(status == "F", "EnvioBOLETA_v11.xsd").otherwise("EnvioDTE_v10.xsd")
    text = F.concat(F.lit("<EnvioDTE "), pad, F.lit('schemaLocation="'), name, F.lit('"/>'))
    kinds = table(spark, sf, "orders").select(F.coalesce(xml.xsd_kind(text), F.lit("none")).alias("kind"))
    return kinds.groupBy("kind").agg(F.count("*").alias("n"))


# ---- one document per line item

def line_xml(spark, sf) -> DataFrame:
    """(file, text): returned lines lack the price, accepted ones the quantity, part names may repeat as description."""
    d = lines(spark, sf, dealt=True)
    flag = F.col("tipo_codigo")
    line = F.concat(
        _tag("NroLinDet", F.col("nro_linea")), F.lit("<CdgItem>"), _tag("TpoCodigo", F.lit("INT1")), _tag("VlrCodigo", F.col("codigo")),
        F.lit("</CdgItem><CdgItem><TpoCodigo>EAN</TpoCodigo></CdgItem>"), _tag("NmbItem", F.col("nombre_item")),
        _maybe(flag == "N", _tag("DscItem", F.col("descripcion"))), _maybe(flag != "A", _tag("QtyItem", F.col("cantidad"))),
        _maybe(flag != "R", _tag("PrcItem", F.col("precio_unitario"))), _tag("MontoItem", _whole(F.col("monto_item"))))
    head = F.concat(F.lit("<Encabezado><IdDoc><TipoDTE>33</TipoDTE>"), _tag("Folio", F.col("header_id")), F.lit("</IdDoc></Encabezado>"))
    doc = F.concat(F.lit("<Documento>"), head, _tag("Detalle", line), F.lit("</Documento>"))
    return d.select(F.col("line_id").alias("file"), doc.alias("text"))


@query("xml_lines", with_roles("lins", """
  SELECT line_id AS file, nro_linea, 'INT1' AS tipo_codigo, nombre_item, codigo,
    CASE WHEN tipo_codigo = 'N' THEN descripcion ELSE nombre_item END AS descripcion,
    CAST(CASE WHEN tipo_codigo <> 'A' THEN cantidad
      ELSE CAST((2 * m * 100 * 1000000 + c) // (2 * c) AS DECIMAL(38,0)) / 1000000 END AS DECIMAL(18,6)) AS cantidad,
    CAST(CASE WHEN tipo_codigo <> 'R' THEN precio_unitario
      ELSE CAST((2 * m * 100 + q) // (2 * q) AS DECIMAL(38,0)) / 100 END AS DECIMAL(18,6)) AS precio_unitario,
    CAST(m AS DECIMAL(18,2)) AS monto_item
  FROM (SELECT *, CAST(floor(monto_item) AS HUGEINT) AS m, CAST(cantidad AS HUGEINT) AS q, CAST(precio_unitario * 100 AS HUGEINT) AS c FROM lins)"""))
def xml_lines(spark, sf):
    """Line columns with the missing price or quantity derived."""
    return xml.line_rows(xml.whole_file_documents(line_xml(spark, sf)), F.col("file"))


@query("xml_line_totals", with_roles("lins", """
  SELECT header_id, count(*) AS n_lines, CAST(sum(CAST(floor(monto_item) AS BIGINT)) AS DECIMAL(28,2)) AS sumdet FROM lins GROUP BY 1"""))
def xml_line_totals(spark, sf):
    """Lines parsed and added up per folio, from XML text to aggregate in one job."""
    folio = scalars.whole(F.col("doc.Encabezado.IdDoc.Folio")).alias("header_id")
    each = xml.line_rows(xml.whole_file_documents(line_xml(spark, sf)), folio)
    return each.groupBy("header_id").agg(
        F.count("*").alias("n_lines"), F.sum("monto_item").cast("decimal(28,2)").alias("sumdet"))


# ---- HTML and plain text

HTML = r"""regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"""
SHOWN = f"""shown AS (SELECT page_id, trim(regexp_replace(
  replace(replace(replace(replace(replace(replace({HTML}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&'),
  '\\s+', ' ', 'g')) AS text FROM pages)"""


@query("html_text", with_roles("", "SELECT * FROM shown", SHOWN))
def html_text(spark, sf):
    return table(spark, sf, "pages", dealt=True).select("page_id", visible_text(F.col("html")).alias("text"))


@query("plain_text", "SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents")
def plain_text_documents(spark, sf):
    name = F.concat(F.lit("d"), "doc_id", F.lit(".txt"))
    return table(spark, sf, "documents", dealt=True).select("doc_id", plain_text(name, F.col("text")).alias("text"))


def order_pages(spark, sf) -> DataFrame:
    """Printed documents as HTML, labels and date style by document type."""
    d = documents(spark, sf, parties=True, dealt=True)
    tipo, day = F.col("tipo_dte"), F.col("fecha_emision")

    def by_type(invoice, receipt, note) -> Column:
        return F.when(tipo == 33, invoice).when(tipo == 39, receipt).otherwise(note)

    rut = F.concat(F.lpad("rut_emisor", 8, "1"), F.lit("-K"))
    amount = F.concat(F.format_number(F.floor("mnt_total"), 0))
    pesos = F.concat(F.lit("$ "), F.translate(amount, ",", "."), F.lit(",50"))
    body = F.concat(
        F.lit("<html><head><style>p{}</style></head><body><h1>"),
        by_type(F.lit("FACTURA ELECTR&Oacute;NICA</h1><i>exenta"), F.lit("Boleta</h1><i>de venta"), F.lit("Nota de Cr&eacute;dito</h1><i>")),
        F.lit("</i><p>"), by_type(F.lit("Folio: "), F.lit("N° "), F.lit("Nro. #")), F.col("folio") + 100, F.lit("</p>\n<td>"),
        by_type(F.lit("RUT Emisor: "), F.lit("Rut Empresa "), F.lit("RUT EMISOR:")), rut, F.lit("</td><td>"),
        by_type(F.lit("RUT Receptor: "), F.lit("RUT Cliente: "), F.lit("RUT Destinatario: ")), F.concat(F.lpad("rut_receptor", 7, "2"), F.lit("-1")),
        F.lit("</td><b>"), by_type(F.lit("Fecha Emisi&oacute;n: "), F.lit("FECHA "), F.lit("FchEmis: ")),
        by_type(F.date_format(day, "dd-MM-yyyy"), F.date_format(day, "yyyy/M/d"), F.date_format(day, "dd/MM/yy")), F.lit("</b>"),
        by_type(F.lit("Monto Total: "), F.lit("Total a Pagar "), F.lit("MntTotal:")), pesos, F.lit("</body></html>"))
    return d.select("header_id", body.alias("html"))


@query("text_headers", with_roles("docs", """
  SELECT header_id, CASE WHEN tipo_dte = 33 THEN 34 ELSE tipo_dte END AS tipo_dte, folio + 100 AS folio, lpad(rut_emisor, 8, '1') || '-K' AS rut_emisor,
    lpad(rut_receptor, 7, '2') || '-1' AS rut_receptor, fecha_emision,
    CAST(floor(mnt_total) + floor(mnt_total) % 2 AS BIGINT) AS mnt_total FROM docs"""))
def text_headers(spark, sf):
    """Header fields from the visible text; halves round to the even amount."""
    pages = order_pages(spark, sf).select("header_id", visible_text(F.col("html")).alias("text"))
    return headers_from_text(pages)


@query("document_types", """
  SELECT CASE WHEN p_name LIKE '%widget%' THEN 61 WHEN p_name LIKE '%bolt%' THEN 56 WHEN p_name LIKE '%gear%' THEN 39
    WHEN p_name LIKE '%rod%' AND p_type = 'PROMO' THEN 34 WHEN p_name LIKE '%rod%' THEN 33 ELSE 0 END AS tipo_dte, count(*) AS n FROM part GROUP BY 1""")
def document_types(spark, sf):
    """Types from words, the specific ones first."""
    name = F.col("p_name")
    for word, other in {"widget": "NOTA DE CRÉDITO a factura", "bolt": "nota de debito", "gear": "Boleta / Factura", "rod": "factura"}.items():
        name = F.replace(name, F.lit(word), F.lit(other))
    text = F.concat(F.when(F.col("p_type") == "PROMO", "Exenta\n").otherwise(""), name)
    return table(spark, sf, "part").select(F.coalesce(document_type(text), F.lit(0)).alias("tipo_dte")).groupBy("tipo_dte").agg(F.count("*").alias("n"))


@query("written_amounts", """
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(floor(o_totalprice) + floor(o_totalprice) % 2 AS BIGINT) END AS amount FROM orders""")
def written_amounts(spark, sf):
    """Amounts as printed, some not readable."""
    grouped = F.translate(F.format_number(F.floor("o_totalprice"), 0), ",", ".")
    text = F.when(F.col("o_orderstatus") == "P", F.concat(grouped, F.lit(" pesos"))).otherwise(F.concat(F.lit("$ "), grouped, F.lit(",5")))
    return table(spark, sf, "orders").select("o_orderkey", scalars.peso_amount(text).alias("amount"))


@query("written_days", """
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND day(o_orderdate) > 12 THEN NULL
    WHEN o_orderstatus = 'P' THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def written_days(spark, sf):
    """Day-first, ISO and two-digit-year dates; month-first ones are read as day-first or not at all."""
    d, status = F.col("o_orderdate"), F.col("o_orderstatus")
    text = F.when(status == "F", F.date_format(d, "d/M/yy")).when(status == "O", F.date_format(d, "yyyy\\M\\d")).otherwise(F.date_format(d, "MM-dd-yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", scalars.written_day(text).alias("day"))


@query("tax_ids", """
  SELECT c_custkey, r || '-K' AS rut, length(r) BETWEEN 7 AND 9 AS valid
  FROM (SELECT c_custkey, CAST(c_custkey * 7919 AS VARCHAR) AS r FROM customer)""")
def tax_ids(spark, sf):
    """Ids as typed, with dots, spaces, lower case and without hyphen, in canonical form."""
    digits = (F.col("c_custkey") * 7919).cast("string")
    typed = F.concat(F.lit(" "), F.translate(F.format_number(F.col("c_custkey") * 7919, 0), ",", "."), F.when(F.col("c_nationkey") > 12, " k").otherwise("-K "))
    rut = scalars.clean_rut(typed)
    return table(spark, sf, "customer").select("c_custkey", rut.alias("rut"), scalars.is_rut(rut).alias("valid"))


# ---- discovery

@query("new_files", """
  SELECT f.file FROM (SELECT '/in/' || doc_id || CASE WHEN lang = 'en' THEN '.xml' ELSE '.XML' END AS file, doc_id FROM documents) f
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)""")
def new_files(spark, sf):
    """Files to load: unseen names, and failed ones because a retry is asked for."""
    listed = table(spark, sf, "documents").select(
        F.concat(F.lit("/in/"), "doc_id", F.when(F.col("lang") == "en", ".xml").otherwise(".XML")).alias("file"))
    registry = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").select(
        F.concat(F.lit("/in/"), "doc_id", F.when(F.col("lang") == "en", ".xml").otherwise(".XML")).alias("file_id"),
        F.when(F.col("toxic") == 1, "FAILED").otherwise("OK").alias("status"))
    return xml.unseen(listed, registry, retry_failed=True)
