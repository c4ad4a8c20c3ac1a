"""Registered queries: what the sinks wrote, read back from the files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators import curated
from folioflow.plans import quality_queries, report_queries  # noqa: F401  their SQL is used again
from folioflow.plans.registry import SQL, query
from folioflow.session import work_folder
from folioflow.sources.store import Store, publish, write_export
from folioflow.sources.tables import documents


@query("exported_file", SQL["export_rows"])
def exported_file(spark, sf) -> DataFrame:
    """The CSV export, read back with its titles and the types of the rows."""
    rows = report_queries.export_rows(spark, sf)
    folder = work_folder(spark, "export")
    write_export(rows, folder)
    return spark.read.schema(rows.schema).option("header", "true").csv(folder)


@query("health_upsert", SQL["daily_health"])
def health_upsert(spark, sf) -> DataFrame:
    """Days of health written twice: first all with a wrong score, then the right ones over them."""
    store = Store(spark, work_folder(spark, "health"))
    days = report_queries.health_days(spark, sf)
    store.upsert_health(days.withColumn("score", F.lit(0).cast("decimal(5,2)")))
    store.upsert_health(days)
    return store.health().select(*days.columns)


@query("published_daily_totals", SQL["daily_totals"])
def published_daily_totals(spark, sf) -> DataFrame:
    """Daily totals published by month, twice, and read back."""
    folder = work_folder(spark, "published")
    view = curated.daily_totals(documents(spark, sf))
    for _ in range(2):
        publish(view, folder, "fecha_emision")
    return spark.read.schema(view.schema).parquet(folder).select(*view.columns)


@query("audit_append", """
  SELECT CAST(user_id AS VARCHAR) AS "user", event_type AS action, '/action/' || event_type AS path, 'POST' AS method, 0 AS status FROM events
  UNION ALL SELECT '-', event_type, '/action/' || event_type, 'POST', 0 FROM events WHERE event_type = 'error'""")
def audit_append(spark, sf) -> DataFrame:
    """Two appends to the audit log, with and without a user; the rest are defaults."""
    store = Store(spark, work_folder(spark, "audit"))
    events = spark.read.parquet(f"{sf}/events.parquet")
    store.append_audit(events.select(F.col("user_id").cast("string").alias("user"), F.col("event_type").alias("action")))
    store.append_audit(events.filter("event_type = 'error'").select(F.col("event_type").alias("action")))
    return store.audit().select("user", "action", "path", "method", "status")
