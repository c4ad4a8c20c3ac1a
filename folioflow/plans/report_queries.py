"""Registered queries: lists, health, runs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from folioflow.operators import health, listing
from folioflow.plans.registry import query, with_roles
from folioflow.sources.tables import audit_log, documents, lines, registered_files, run_log, table

AS_OF = date(2024, 1, 31)
SANTIAGO = "CAST(timezone('America/Santiago', timezone('UTC', {})) AS DATE)"

# ---- lists

FOUND = """FROM docs WHERE tipo_dte = 33 AND fecha_emision BETWEEN DATE '1996-03-01' AND DATE '1999-06-30'
  AND (rut_emisor ILIKE '%7%' OR razon_social_emisor ILIKE '%7%') AND (rut_receptor ILIKE '%nation_1%' OR razon_social_receptor ILIKE '%nation_1%')"""
FILTERS = dict(tipo=" 33 ", folio="x", date_from="1999-06-30", date_to="1996-03-01", issuer=" 7 ", receiver="nation_1")


@query("document_filter", with_roles("docs", f"SELECT * {FOUND} ORDER BY header_id DESC LIMIT 500"))
def document_filter(spark, sf):
    return listing.latest_documents(documents(spark, sf, parties=True), **FILTERS)


@query("document_total", with_roles("docs", f"SELECT count(*) AS total {FOUND}"))
def document_total(spark, sf):
    return listing.total_rows(listing.documents(documents(spark, sf, parties=True), **FILTERS))


@query("type_pick_list", with_roles("docs", "SELECT DISTINCT tipo_dte FROM docs"))
def type_pick_list(spark, sf):
    return listing.pick_list(documents(spark, sf), "tipo_dte")


@query("document_list", with_roles("docs", """
  SELECT header_id AS id, tipo_dte AS tipo, folio, fecha_emision AS fecha, rut_emisor || ' - ' || coalesce(razon_social_emisor, '') AS emisor,
    rut_receptor || ' - ' || coalesce(razon_social_receptor, '') AS receptor, CAST(mnt_total AS VARCHAR) AS total FROM docs"""))
def document_list(spark, sf):
    return listing.listed_documents(documents(spark, sf, parties=True))


@query("export_rows", with_roles("docs", """
  SELECT header_id AS "ID", tipo_dte AS "Tipo", folio AS "Folio", fecha_emision AS "Fecha", rut_emisor AS "Emisor",
    rut_receptor AS "Receptor", mnt_total AS "Monto Total" FROM docs WHERE fecha_emision >= DATE '1998-01-01'"""))
def export_rows(spark, sf):
    return listing.export_rows(documents(spark, sf, parties=True), date_from="1998-01-01", date_to="2000-02-30")


@query("one_document", with_roles("docs lins", """
  SELECT d.header_id, d.tipo_dte, d.mnt_total, l.line_id, l.nro_linea, l.nombre_item, l.cantidad, l.monto_item
  FROM docs d LEFT JOIN lins l USING (header_id) WHERE d.header_id = 42"""))
def one_document(spark, sf):
    return listing.one_document(documents(spark, sf), lines(spark, sf), 42).select(
        "header_id", "tipo_dte", "mnt_total", "line_id", "nro_linea", "nombre_item", "cantidad", "monto_item")


@query("files_newest_first", with_roles("files", "SELECT * FROM files"))
def files_newest_first(spark, sf):
    return listing.files_newest_first(registered_files(spark, sf))


ENTRIES = """FROM audit WHERE method = 'POST' AND path ILIKE '%ACTION/e%' AND status = 500 AND ts_on BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'"""
ENTRY_FILTERS = dict(method="POST", path="ACTION/e", status="500", date_from="2024-01-12", date_to="2024-01-05", stored_zone="UTC")


@query("audit_page", with_roles("audit", f"SELECT * {ENTRIES} ORDER BY ts DESC, id DESC LIMIT 50 OFFSET 50"))
def audit_page(spark, sf):
    return listing.page_of(listing.audit_entries(audit_log(spark, sf), **ENTRY_FILTERS), "ts", "id", page=2)


@query("audit_total", with_roles("audit", f"SELECT count(*) AS total {ENTRIES}"))
def audit_total(spark, sf):
    return listing.total_rows(listing.audit_entries(audit_log(spark, sf), **ENTRY_FILTERS))


@query("audit_of_user", with_roles("audit", """SELECT * FROM audit WHERE "user" = '7'"""))
def audit_of_user(spark, sf):
    return listing.audit_entries(audit_log(spark, sf), user="7", status="", stored_zone="UTC")


@query("runs_page", with_roles("runs", f"""
  SELECT run_id, job, source, started_at, ended_at, status, files_total, files_ok, files_failed, headers_inserted,
    details_inserted, dq_violations, {SANTIAGO.format('started_at')} AS started_on FROM runs
  WHERE job = 'etl_daily' AND status = 'PARTIAL' AND source ILIKE '%CLI%' AND {SANTIAGO.format('started_at')} >= DATE '2024-01-03'
  ORDER BY started_at DESC, run_id DESC LIMIT 50"""))
def runs_page(spark, sf):
    found = listing.runs(run_log(spark, sf), job="etl_daily", status="PARTIAL", source="CLI", started_from="2024-01-03",
                         started_to="soon", stored_zone="UTC")
    return listing.page_of(found, "started_at", "run_id")


@query("run_by_id", with_roles("runs", "SELECT * FROM runs WHERE run_id = '7-20240105'"))
def run_by_id(spark, sf):
    return listing.run_by_id(run_log(spark, sf), "7-20240105")


# ---- health and runs

@query("run_log", with_roles("runs", "SELECT * FROM runs"))
def runs_with_status(spark, sf):
    """Counters and final status of every run."""
    return run_log(spark, sf)


HEALTH = f"""health AS (
  SELECT *, CAST(CASE WHEN headers <= 0 THEN 100 ELSE round(greatest(0.0, least(100.0, 100.0 - CAST(100.0 * violations_total AS DOUBLE) / headers)), 2) END
    AS DECIMAL(5,2)) AS score
  FROM (SELECT {SANTIAGO.format('started_at')} AS day, CAST(sum(headers_inserted) AS BIGINT) AS headers,
      CAST(sum(details_inserted) AS BIGINT) AS details, CAST(sum(dq_violations) AS BIGINT) AS violations_total
    FROM runs WHERE job = 'etl_daily' GROUP BY 1)),
last30 AS (SELECT * FROM health ORDER BY day DESC LIMIT 30)"""


def health_days(spark, sf):
    return health.daily_health(run_log(spark, sf), stored_zone="UTC")


@query("daily_health", with_roles("runs", "SELECT * FROM health", HEALTH))
def daily_health(spark, sf):
    return health_days(spark, sf)


@query("health_of_day", with_roles("runs", """
  SELECT DATE '2024-01-09' AS day, coalesce(max(headers), 0) AS headers, coalesce(max(details), 0) AS details,
    coalesce(max(violations_total), 0) AS violations_total, CAST(coalesce(max(score), 100) AS DECIMAL(5,2)) AS score
  FROM health WHERE day = DATE '2024-01-09'""", HEALTH))
def health_of_day(spark, sf):
    return health.daily_health(run_log(spark, sf), stored_zone="UTC", day=date(2024, 1, 9))


@query("health_trend", with_roles("runs", """
  SELECT *, CAST(round(avg(CAST(score AS DOUBLE)) OVER (ORDER BY day ROWS 6 PRECEDING), 2) AS DECIMAL(5,2)) AS avg7,
    CAST(round(avg(CAST(score AS DOUBLE)) OVER (ORDER BY day ROWS 29 PRECEDING), 2) AS DECIMAL(5,2)) AS avg30,
    CAST(score - lag(score) OVER (ORDER BY day) AS DECIMAL(5,2)) AS delta1,
    CASE WHEN score >= 95 THEN 'ok' WHEN score >= 80 THEN 'warn' ELSE 'bad' END AS band FROM last30""", HEALTH))
def health_trend(spark, sf):
    return health.health_trend(health_days(spark, sf))


@query("best_and_worst_day", with_roles("runs", """
  SELECT * FROM (SELECT day AS best_day, score AS best_score FROM last30 ORDER BY score DESC, day DESC LIMIT 1),
    (SELECT day AS worst_day, score AS worst_score FROM last30 ORDER BY score, day DESC LIMIT 1)""", HEALTH))
def best_and_worst_day(spark, sf):
    return health.best_and_worst_day(health_days(spark, sf))


SPARK = """SELECT '{v}' AS series, day,
  CAST(round(CASE WHEN count(*) OVER () = 1 THEN 120.0 ELSE 2 + (row_number() OVER (ORDER BY day) - 1) * 236.0 / (count(*) OVER () - 1) END, 1) AS DECIMAL(8,1)) AS x,
  CAST(round(2 + 36 * (1 - (CAST({v} AS DOUBLE) - min({v}) OVER ()) / (CASE WHEN max({v}) OVER () = min({v}) OVER () THEN 1.0 ELSE max({v}) OVER () - min({v}) OVER () END)), 1) AS DECIMAL(8,1)) AS y
  FROM last30"""


@query("health_spark_lines", with_roles("runs", SPARK.format(v="score") + " UNION ALL " + SPARK.format(v="violations_total"), HEALTH))
def health_spark_lines(spark, sf):
    days = health_days(spark, sf)
    return health.spark_line(days, "score").select(F.lit("score").alias("series"), "*").unionByName(
        health.spark_line(days, "violations_total").select(F.lit("violations_total").alias("series"), "*"))


@query("run_statistics", with_roles("runs", """
  SELECT CAST(round(avg(s), 2) AS DECIMAL(18,2)) AS avg_sec, CAST(round(max(s), 2) AS DECIMAL(18,2)) AS max_sec, count(*) AS runs_total,
    count(*) FILTER (status = 'OK') AS runs_ok, CAST(round(count(*) FILTER (status = 'OK') * 100.0 / count(*), 2) AS DECIMAL(18,2)) AS success_rate
  FROM (SELECT status, date_diff('microsecond', started_at, ended_at) / 1000000.0 AS s FROM runs
    WHERE job = 'etl_daily' AND started_at >= DATE '2024-01-01' AND ended_at IS NOT NULL)"""))
def run_statistics(spark, sf):
    return health.run_statistics(run_log(spark, sf), AS_OF)


@query("service_snapshot", with_roles("runs docs files", """
  SELECT CAST((SELECT count(*) FROM files) - (SELECT count(DISTINCT file_id) FROM docs) AS BIGINT) AS backlog_unparsed_files,
    run_id, job, status, started_at, ended_at FROM (SELECT * FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 1)"""))
def service_snapshot(spark, sf):
    return health.service_snapshot(run_log(spark, sf), registered_files(spark, sf), documents(spark, sf))


@query("daily_events", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def daily_events(spark, sf):
    return table(spark, sf, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
