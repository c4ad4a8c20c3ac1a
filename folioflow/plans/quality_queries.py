"""Registered queries: curated views, rules, consistency."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators import consistency, curated, dedupe, listing, quality
from folioflow.plans.registry import query, with_roles
from folioflow.schema import missing_rules, rule_catalogue
from folioflow.sources.tables import documents, lines, registered_files, run_log, table

# Thresholds that hit some rows and miss others on the given tables.
LIMITS = quality.Limits(max_bad_quantity=2, amount_gap=10_000, first_day="1995-07-01", days_ahead=1)
AS_OF = date(2001, 5, 31)
TOTALS_GAP = 100_000
STAMP = "2024-06-01 03:30:00"


def violations(spark, sf) -> DataFrame:
    return quality.find_violations(
        documents(spark, sf), lines(spark, sf), as_of=AS_OF, run_id="r1", limits=LIMITS, created_at=STAMP)


DQ1 = "coalesce(cantidad, 0) <= 2 OR coalesce(precio_unitario, 0) < 0"
DQ2 = "abs(coalesce(monto_item, 0) - coalesce(cantidad, 0) * coalesce(precio_unitario, 0)) > 10000"
DQ4 = "fecha_emision < DATE '1995-07-01' OR fecha_emision > DATE '2001-06-01'"
VIOL = f"""viol AS (
  SELECT 'r1:' || v.rule_code || ':' || v.entity_id AS violation_id, 'r1' AS run_id, CAST(r.rule_id AS BIGINT) AS rule_id,
    r.entity, v.entity_id, v.header_id, r.description AS message
  FROM (SELECT 'DQ1' AS rule_code, line_id AS entity_id, CAST(header_id AS VARCHAR) AS header_id FROM lins WHERE {DQ1}
    UNION ALL SELECT 'DQ2', line_id, CAST(header_id AS VARCHAR) FROM lins WHERE {DQ2}
    UNION ALL SELECT 'DQ4', CAST(header_id AS VARCHAR), CAST(header_id AS VARCHAR) FROM docs WHERE {DQ4}) v
  JOIN rules r USING (rule_code))"""
BASE = "docs lins rules"


@query("daily_flagged_lines", with_roles("docs lins", f"""
  SELECT fecha_emision, tipo_dte, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(monto_item) AS DECIMAL(38,2)) AS monto_total,
    count(*) FILTER ({DQ1}) AS n_error, count(*) FILTER ({DQ2}) AS n_warn
  FROM lins JOIN docs USING (header_id) GROUP BY fecha_emision, tipo_dte"""))
def daily_flagged_lines(spark, sf):
    """Lines, amounts and broken rules per day and document type."""
    return curated.flagged_line_totals(documents(spark, sf), lines(spark, sf), LIMITS)


DETAIL = """header_id, fecha_emision, tipo_dte, folio, rut_emisor, razon_social_emisor, rut_receptor, razon_social_receptor,
  mnt_neto, iva, mnt_total, line_id AS detail_id, nro_linea, tipo_codigo, codigo, nombre_item, descripcion, cantidad,
  precio_unitario, monto_item"""


@query("line_join", with_roles("docs lins", f"SELECT {DETAIL} FROM lins JOIN docs USING (header_id)"))
def line_join(spark, sf):
    return curated.line_detail(documents(spark, sf, parties=True), lines(spark, sf))


@query("fact_lines_flags", with_roles(BASE, f"""
  SELECT {DETAIL},
    EXISTS (SELECT 1 FROM viol v JOIN rules r USING (rule_id) WHERE v.entity = 'detail' AND v.entity_id = lins.line_id AND r.rule_level = 'ERROR') AS dq_has_error,
    EXISTS (SELECT 1 FROM viol v JOIN rules r USING (rule_id) WHERE v.entity = 'detail' AND v.entity_id = lins.line_id AND r.rule_level = 'WARN') AS dq_has_warn
  FROM lins JOIN docs USING (header_id)""", VIOL))
def fact_lines_flags(spark, sf):
    return curated.fact_lines(documents(spark, sf, parties=True), lines(spark, sf), violations(spark, sf), rule_catalogue(spark))


@query("daily_totals", with_roles("docs", """
  SELECT fecha_emision, tipo_dte, rut_emisor, count(*) AS n_docs, CAST(sum(mnt_total) AS DECIMAL(38,2)) AS monto_total
  FROM docs GROUP BY ALL"""))
def daily_totals(spark, sf):
    return curated.daily_totals(documents(spark, sf))


@query("daily_kpi", with_roles("docs", """
  SELECT fecha_emision AS dia, count(*) AS dtes, CAST(sum(mnt_total) AS DECIMAL(38,2)) AS monto_total FROM docs GROUP BY ALL"""))
def daily_kpi(spark, sf):
    return curated.daily_kpi(documents(spark, sf))


@query("type_stats", with_roles("docs", """
  SELECT tipo_dte, count(*) AS n, CAST(sum(mnt_total) AS DECIMAL(38,2)) AS monto FROM docs GROUP BY ALL"""))
def type_stats(spark, sf):
    return curated.type_stats(documents(spark, sf))


@query("dim_issuer", with_roles("docs", """
  SELECT rut_emisor, max(razon_social_emisor) AS razon_social_emisor FROM docs GROUP BY rut_emisor"""))
def dim_issuer(spark, sf):
    return curated.dim_issuer(documents(spark, sf, parties=True))


@query("dim_receiver", with_roles("docs", """
  SELECT rut_receptor, max(razon_social_receptor) AS razon_social_receptor FROM docs GROUP BY rut_receptor"""))
def dim_receiver(spark, sf):
    return curated.dim_receiver(documents(spark, sf, parties=True))


@query("stage_headers", with_roles("docs", "SELECT * FROM docs"))
def stage_headers(spark, sf):
    return documents(spark, sf, parties=True)


@query("stage_lines", with_roles("lins", "SELECT * FROM lins"))
def stage_lines(spark, sf):
    return lines(spark, sf)


@query("dq_violations", with_roles(BASE, "SELECT * FROM viol", VIOL))
def dq_violations(spark, sf):
    return violations(spark, sf).drop("created_at")


@query("dq_totals_rule", with_roles("docs lins", f"""
  SELECT 'r1:DQ3:' || header_id AS violation_id, 'r1' AS run_id, CAST(4 AS BIGINT) AS rule_id, 'header' AS entity,
    CAST(header_id AS VARCHAR) AS entity_id, CAST(header_id AS VARCHAR) AS header_id, 'suma(detalle) != total' AS message
  FROM docs LEFT JOIN (SELECT header_id, sum(monto_item) AS s FROM lins GROUP BY header_id) USING (header_id)
  WHERE abs(coalesce(mnt_total, 0) - coalesce(s, 0)) > {TOTALS_GAP}"""))
def dq_totals_rule(spark, sf):
    found = quality.find_violations(
        documents(spark, sf), lines(spark, sf, items=False).withColumn("precio_unitario", F.lit(0)), as_of=AS_OF,
        run_id="r1", limits=quality.Limits(amount_gap=TOTALS_GAP), check_totals=True)
    return found.filter("rule_id = 4").drop("created_at")


@query("dq_results", with_roles("docs lins", f"""
  SELECT 'DQ1' AS rule_code, count(*) FILTER (NOT ({DQ1})) AS passed, count(*) FILTER ({DQ1}) AS failed FROM lins
  UNION ALL SELECT 'DQ2', count(*) FILTER (NOT ({DQ2})), count(*) FILTER ({DQ2}) FROM lins
  UNION ALL SELECT 'DQ4', count(*) FILTER (NOT ({DQ4})), count(*) FILTER ({DQ4}) FROM docs"""))
def dq_results(spark, sf):
    return quality.rule_results(lines(spark, sf), quality.line_rules(LIMITS)).unionByName(
        quality.rule_results(documents(spark, sf), quality.header_rules(AS_OF, LIMITS)))


@query("violations_enriched", with_roles(BASE, """
  SELECT v.violation_id, v.run_id, v.rule_id, v.entity, v.entity_id, v.message, r.rule_code, r.rule_level,
    CASE WHEN v.entity = 'detail' THEN CAST(l.header_id AS VARCHAR) ELSE v.entity_id END AS header_id
  FROM viol v JOIN rules r USING (rule_id) LEFT JOIN lins l ON v.entity = 'detail' AND v.entity_id = l.line_id""", VIOL))
def violations_enriched(spark, sf):
    """Owners looked up in the line table, as for violations stored without them."""
    bare = violations(spark, sf).drop("created_at", "header_id")
    return curated.violations_enriched(bare, rule_catalogue(spark), lines(spark, sf, items=False))


@query("violations_by_level", with_roles(BASE, "SELECT rule_level, count(*) AS n FROM viol JOIN rules USING (rule_id) GROUP BY 1", VIOL))
def violations_by_level(spark, sf):
    return quality.by_level(violations(spark, sf), rule_catalogue(spark))


@query("violations_by_rule", with_roles(BASE, "SELECT rule_code, count(*) AS n FROM viol JOIN rules USING (rule_id) GROUP BY 1", VIOL))
def violations_by_rule(spark, sf):
    return quality.by_rule(violations(spark, sf), rule_catalogue(spark))


# Violations dated by the day of their document, so that there are many days to count.
DATED = VIOL + """, dated AS (
  SELECT v.*, o_orderdate + INTERVAL 2 HOUR AS created_at FROM viol v JOIN orders ON CAST(o_orderkey AS VARCHAR) = v.header_id)"""
LOCAL = "CAST(timezone('America/Santiago', timezone('UTC', {})) AS DATE)"


def dated_violations(spark, sf) -> DataFrame:
    when = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("header_id"),
        (F.col("o_orderdate") + F.expr("INTERVAL 2 HOURS")).alias("created_at"))
    return violations(spark, sf).drop("created_at").join(when, "header_id")


@query("violations_by_day", with_roles(BASE, f"""
  SELECT {LOCAL.format('created_at')} AS day, count(*) AS n FROM dated GROUP BY 1""", DATED))
def violations_by_day(spark, sf):
    return quality.by_day(dated_violations(spark, sf), stored_zone="UTC")


@query("dq_summary", with_roles(BASE, f"""
  SELECT 'by_level' AS section, rule_level AS item, CAST(count(*) AS BIGINT) AS n FROM dated JOIN rules USING (rule_id) GROUP BY 2
  UNION ALL SELECT 'by_rule', rule_code, count(*) FROM dated JOIN rules USING (rule_id) GROUP BY 2
  UNION ALL SELECT 'by_day', CAST({LOCAL.format('created_at')} AS VARCHAR), count(*) FROM dated GROUP BY 2""", DATED))
def dq_summary(spark, sf):
    return quality.quality_summary(dated_violations(spark, sf), rule_catalogue(spark), stored_zone="UTC")


@query("violations_page", with_roles(BASE, f"""
  SELECT violation_id, rule_code, rule_level, v.entity, entity_id, header_id, created_at, {LOCAL.format('created_at')} AS created_on
  FROM dated v JOIN rules USING (rule_id)
  WHERE rule_level = 'WARN' AND v.entity = 'detail' AND {LOCAL.format('created_at')} BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
  ORDER BY created_at DESC, violation_id DESC LIMIT 50 OFFSET 100""", DATED))
def violations_page(spark, sf):
    enriched = quality.with_rules(dated_violations(spark, sf), rule_catalogue(spark))
    found = listing.violations(enriched, level="WARN", entity="detail", date_from="1999-12-31", date_to="1996-01-01", stored_zone="UTC")
    return listing.page_of(found, "created_at", "violation_id", page=3).select(
        "violation_id", "rule_code", "rule_level", "entity", "entity_id", "header_id", "created_at", "created_on")


@query("violations_total", with_roles(BASE, """
  SELECT count(*) AS total FROM viol JOIN rules USING (rule_id) WHERE rule_code = 'DQ2' AND header_id = '7'""", VIOL))
def violations_total(spark, sf):
    enriched = quality.with_rules(violations(spark, sf), rule_catalogue(spark))
    return listing.total_rows(listing.violations(enriched, code="DQ2", header_id=" 7 ", date_from="no date"))


@query("violations_of_documents", with_roles(BASE, """
  SELECT v.* FROM viol v WHERE v.header_id IN (SELECT CAST(header_id AS VARCHAR) FROM docs WHERE tipo_dte = 61)""", VIOL))
def violations_of_documents(spark, sf):
    credit_notes = documents(spark, sf).filter("tipo_dte = 61")
    return quality.of_documents(violations(spark, sf).drop("created_at"), credit_notes)


@query("lines_of_documents", with_roles("docs lins", """
  SELECT count(*) AS n_details FROM lins WHERE header_id IN (SELECT header_id FROM docs WHERE tipo_dte = 33)"""))
def lines_of_documents(spark, sf):
    kept = quality.lines_of_documents(lines(spark, sf, items=False), documents(spark, sf).filter("tipo_dte = 33"))
    return kept.agg(F.count("*").alias("n_details"))


@query("rule_seed", with_roles("rules", """
  SELECT CAST(rule_id AS BIGINT) AS rule_id, rule_code, rule_level, entity, description FROM rules
  WHERE rule_code NOT IN (SELECT 'DQ' || l_linenumber FROM lineitem WHERE l_linenumber <= 2)"""))
def rule_seed(spark, sf):
    """Catalogue rows to add to a rule table that knows some codes."""
    known = table(spark, sf, "lineitem").filter("l_linenumber <= 2").select(
        F.concat(F.lit("DQ"), "l_linenumber").alias("rule_code")).distinct()
    return missing_rules(known).select("rule_id", "rule_code", "rule_level", "entity", "description")


@query("headers_without_lines", with_roles("docs", """
  SELECT header_id, tipo_dte, folio, rut_emisor FROM docs WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = header_id)"""))
def headers_without_lines(spark, sf):
    return consistency.headers_without_lines(
        documents(spark, sf).select("header_id", "tipo_dte", "folio", "rut_emisor"), lines(spark, sf, items=False))


@query("orphan_lines", with_roles("docs lins", """
  SELECT line_id, header_id FROM lins WHERE header_id NOT IN (SELECT header_id FROM docs WHERE tipo_dte <> 61)"""))
def orphan_lines(spark, sf):
    """Lines whose document is not among invoices and receipts."""
    return consistency.orphan_lines(
        lines(spark, sf, items=False).select("line_id", "header_id"), documents(spark, sf).filter("tipo_dte <> 61"))


# Issuer, day and type as the key, so that the given tables hold duplicates.
DUP_KEY = ["tipo_dte", "fecha_emision", "rut_emisor"]


@query("duplicate_keys", with_roles("docs", """
  SELECT tipo_dte, fecha_emision, rut_emisor, count(*) AS n FROM docs GROUP BY ALL HAVING count(*) > 1"""))
def duplicate_keys(spark, sf):
    return consistency.duplicate_keys(documents(spark, sf), DUP_KEY)


@query("first_document_wins", with_roles("docs", """
  SELECT tipo_dte, fecha_emision, rut_emisor, header_id, mnt_total FROM docs
  QUALIFY row_number() OVER (PARTITION BY tipo_dte, fecha_emision, rut_emisor ORDER BY header_id) = 1"""))
def first_document_wins(spark, sf):
    rows = documents(spark, sf).select(*DUP_KEY, "header_id", "mnt_total")
    return dedupe.first_wins(rows, DUP_KEY, ["header_id"])


@query("first_line_wins", with_roles("lins", """
  SELECT header_id, nro_linea, line_id, monto_item FROM lins
  QUALIFY row_number() OVER (PARTITION BY header_id, nro_linea ORDER BY line_id) = 1"""))
def first_line_wins(spark, sf):
    rows = lines(spark, sf, items=False).select("header_id", "nro_linea", "line_id", "monto_item")
    return dedupe.first_wins(rows, ["header_id", "nro_linea"], ["line_id"])


@query("first_copy_wins", """
  SELECT text, doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def first_copy_wins(spark, sf):
    rows = table(spark, sf, "documents").select("text", "doc_id", "lang", "source")
    return dedupe.first_wins(rows, ["text"], ["doc_id"])


@query("new_documents", with_roles("docs", """
  SELECT header_id, tipo_dte, folio, rut_emisor, mnt_total FROM docs
  WHERE (tipo_dte, folio, rut_emisor) NOT IN (SELECT (tipo_dte, folio, rut_emisor) FROM docs WHERE fecha_emision < DATE '1999-01-01')"""))
def new_documents(spark, sf):
    """Documents whose business key an earlier load does not hold."""
    docs = documents(spark, sf).select("header_id", "tipo_dte", "folio", "rut_emisor", "mnt_total", "fecha_emision")
    return dedupe.only_new(docs, docs.filter("fecha_emision < DATE '1999-01-01'")).drop("fecha_emision").select(
        "header_id", "tipo_dte", "folio", "rut_emisor", "mnt_total")


@query("repeated_lines", with_roles("lins", """
  SELECT header_id, nro_linea, count(*) AS n FROM lins GROUP BY ALL HAVING count(*) > 1"""))
def repeated_lines(spark, sf):
    return dedupe.repeated_lines(lines(spark, sf, items=False))


MISMATCH = """SELECT header_id, CAST(coalesce({c}, 0) AS DECIMAL(28,2)) AS mnt_total, CAST(coalesce(s, 0) AS DECIMAL(28,2)) AS sumdet
  FROM docs LEFT JOIN (SELECT header_id, sum(monto_item) AS s FROM lins GROUP BY header_id) USING (header_id)
  WHERE abs(coalesce({c}, 0) - coalesce(s, 0)) > {gap}"""


@query("totals_mismatch", with_roles("docs lins", MISMATCH.format(c="mnt_total", gap=TOTALS_GAP)))
def totals_mismatch(spark, sf):
    return consistency.totals_mismatch(documents(spark, sf), lines(spark, sf, items=False), TOTALS_GAP)


@query("net_mismatch_sample", with_roles("docs lins", MISMATCH.format(c="mnt_neto", gap=TOTALS_GAP) + " ORDER BY header_id LIMIT 50"))
def net_mismatch_sample(spark, sf):
    found = consistency.totals_mismatch(documents(spark, sf), lines(spark, sf, items=False), TOTALS_GAP, "mnt_neto")
    return found.orderBy("header_id").limit(consistency.SAMPLE)


INVENTORY = """SELECT 'files.total' AS metric, count(*) AS value FROM files
  UNION ALL SELECT 'files.with_headers', count(DISTINCT file_id) FROM docs
  UNION ALL SELECT 'headers.total', count(*) FROM docs UNION ALL SELECT 'details.total', count(*) FROM lins
  UNION ALL SELECT 'dq.violations_total', count(*) FROM viol"""


@query("inventory", with_roles("docs lins rules files", INVENTORY, VIOL))
def inventory(spark, sf):
    return consistency.inventory(registered_files(spark, sf), documents(spark, sf), lines(spark, sf, items=False), violations(spark, sf))


@query("consistency_report", with_roles("docs lins rules files", INVENTORY + f"""
  UNION ALL SELECT 'headers.without_details', count(*) FROM docs WHERE header_id NOT IN (SELECT header_id FROM lins)
  UNION ALL SELECT 'headers.duplicate_groups_count', count(*) FROM (SELECT 1 FROM docs GROUP BY tipo_dte, folio, rut_emisor HAVING count(*) > 1)
  UNION ALL SELECT 'details.orphans', count(*) FROM lins WHERE header_id NOT IN (SELECT header_id FROM docs)
  UNION ALL SELECT 'totals_check.mismatch_count', count(*) FROM ({MISMATCH.format(c='mnt_total', gap=TOTALS_GAP)})
  UNION ALL SELECT 'dq.by_level.' || rule_level, count(*) FROM viol JOIN rules USING (rule_id) GROUP BY rule_level""", VIOL))
def consistency_report(spark, sf):
    return consistency.consistency_report(
        registered_files(spark, sf), documents(spark, sf), lines(spark, sf, items=False), violations(spark, sf),
        rule_catalogue(spark), TOTALS_GAP)


@query("backlog", with_roles("docs files", """
  SELECT CAST((SELECT count(*) FROM files) - (SELECT count(DISTINCT file_id) FROM docs) AS BIGINT) AS backlog_unparsed_files"""))
def backlog(spark, sf):
    return consistency.backlog(registered_files(spark, sf), documents(spark, sf))


@query("unparsed_files", with_roles("docs files", "SELECT * FROM files WHERE file_id NOT IN (SELECT file_id FROM docs)"))
def unparsed_files(spark, sf):
    return consistency.unparsed_files(registered_files(spark, sf), documents(spark, sf))


@query("violations_per_hundred", with_roles("runs", """
  SELECT run_id, CAST(coalesce(n, 0) AS BIGINT) AS violations, greatest(coalesce(details_inserted, 0), 1) AS lines,
    CAST(round(coalesce(n, 0) * 100.0 / greatest(coalesce(details_inserted, 0), 1), 4) AS DECIMAL(18,4)) AS viol_x_100,
    coalesce(n, 0) * 100.0 / greatest(coalesce(details_inserted, 0), 1) >= 1.0 AS alert
  FROM runs LEFT JOIN (SELECT concat_ws('-', user_id, strftime(ts, '%Y%m%d')) AS run_id, count(*) AS n FROM events
    WHERE event_type = 'error' GROUP BY 1) USING (run_id)"""))
def violations_per_hundred(spark, sf):
    """Error events stand for the violations of their user's run of that day."""
    errors = table(spark, sf, "events").filter("event_type = 'error'").select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("run_id"))
    return quality.violations_per_hundred(errors, run_log(spark, sf))
