"""Registered queries: whole loads into a store, batch and streaming, and the event streams.

Each works in a fresh folder below the shared checkpoint folder.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators.quality import Limits
from folioflow.plans.ingest import Run, ingest_folder, load_documents
from folioflow.plans.parse_queries import XML_HEADERS, order_xml
from folioflow.plans.registry import query, with_roles
from folioflow.session import discard, passing_shuffles, work_folder
from folioflow.sources.store import Store
from folioflow.sources.tables import SCHEMAS, documents
from folioflow.sources.xml_documents import whole_file_documents
from folioflow.streaming.events import append_to, daily_counts, drop_repeats, upsert_days
from folioflow.streaming.ingest import stream_ingest

AS_OF = date(2024, 1, 1)
START = datetime(2024, 1, 1, 3, 0, tzinfo=timezone.utc)
LIMITS = Limits(first_day="1995-07-01")

RUN_COLUMNS = ["run_id", "job", "status", "files_total", "files_ok", "files_failed", "headers_inserted",
               "headers_already_present", "details_inserted", "dq_violations"]

LOADS = XML_HEADERS + """, ok AS (SELECT * FROM parsed WHERE mnt_neto IS NOT NULL),
  early AS (SELECT * FROM ok WHERE tipo_dte <> 39)"""
BROKEN = """count(*) FILTER (tipo_dte = 61 AND abs(mnt_total - mnt_neto) > 1) + count(*) FILTER (fecha_emision < DATE '1995-07-01')"""


@query("repeated_load", with_roles("docs", f"""
  SELECT 'first' AS run_id, 'etl_daily' AS job, 'PARTIAL' AS status, (SELECT count(*) FROM docs WHERE tipo_dte <> 39) AS files_total,
    (SELECT count(*) FROM docs WHERE tipo_dte <> 39) AS files_ok, 0 AS files_failed, count(*) AS headers_inserted,
    0 AS headers_already_present, count(*) AS details_inserted, {BROKEN} AS dq_violations FROM early
  UNION ALL SELECT 'second', 'etl_daily', 'PARTIAL', (SELECT count(*) FROM docs), (SELECT count(*) FROM docs), 0, count(*),
    (SELECT count(*) FROM early), count(*), {BROKEN} FROM ok WHERE tipo_dte = 39""", LOADS))
def repeated_load(spark, sf) -> DataFrame:
    """Run log of two loads, the second repeating the first's documents beside new ones."""
    store = Store(spark, work_folder(spark, "repeated-load"))
    xml = order_xml(spark, sf)
    receipts = documents(spark, sf).filter("tipo_dte = 39").select(F.concat(F.lit("F"), "header_id", F.lit(".xml")).alias("file"))
    for name, files in (("first", xml.join(receipts, "file", "left_anti")), ("second", xml)):
        load_documents(store, whole_file_documents(files), Run(run_id=name, started_at=START), as_of=AS_OF, limits=LIMITS)
    return store.runs().select(*RUN_COLUMNS)


@query("load_with_failing_rules", with_roles("docs", """
  SELECT 'unjudged' AS run_id, 'etl_daily' AS job, 'PARTIAL' AS status, (SELECT count(*) FROM docs) AS files_total, (SELECT count(*) FROM docs) AS files_ok,
    0 AS files_failed, count(*) AS headers_inserted, 0 AS headers_already_present, count(*) AS details_inserted, 0 AS dq_violations,
    true AS rules_failed, count(*) AS visible FROM ok""", LOADS))
def load_with_failing_rules(spark, sf) -> DataFrame:
    """Run log of a load whose rule table cannot be read, beside the documents it left."""
    store = Store(spark, work_folder(spark, "failing-rules"))
    load_documents(store, whole_file_documents(order_xml(spark, sf)), Run(run_id="unjudged", started_at=START), as_of=AS_OF,
                   rules=spark.range(1).select(F.lit("DQ1").alias("rule_code")))
    log = store.runs().select(*RUN_COLUMNS, F.exists("errors", lambda e: e["where"] == "rules").alias("rules_failed"))
    return log.crossJoin(store.read("headers").agg(F.count("*").alias("visible")))


def write_envelopes(spark, sf, folder: str, only: str = "true") -> None:
    """The orders as XML envelopes, one per partition, by Spark's own XML writer."""
    d = documents(spark, sf, parties=True, dealt=True).filter(only)

    def whole(name: str):
        return F.floor(name).cast("bigint")

    header = F.struct(
        F.struct(F.col("tipo_dte").alias("TipoDTE"), F.col("folio").alias("Folio"), F.col("fecha_emision").alias("FchEmis")).alias("IdDoc"),
        F.struct(F.col("rut_emisor").alias("RUTEmisor"), F.col("razon_social_emisor").alias("RznSoc")).alias("Emisor"),
        F.struct(F.col("rut_receptor").alias("RUTRecep"), F.col("razon_social_receptor").alias("RznSocRecep")).alias("Receptor"),
        F.struct(whole("mnt_neto").alias("MntNeto"), whole("iva").alias("IVA"), whole("mnt_total").alias("MntTotal")).alias("Totales"))
    line = F.struct(F.lit(1).alias("NroLinDet"), F.col("razon_social_emisor").alias("NmbItem"), F.lit(2).alias("QtyItem"),
                    whole("mnt_neto").alias("MontoItem"))
    rows = d.select(F.struct(F.col("header_id").alias("_ID"), header.alias("Encabezado"), line.alias("Detalle")).alias("Documento"))
    # Indentation would be about half of the files.
    with passing_shuffles(spark):
        rows.write.format("xml").option("rootTag", "EnvioDTE").option("rowTag", "DTE").option("indent", "").save(folder)


LOADED = with_roles("docs", """
  SELECT concat_ws(':', tipo_dte, folio, rut_emisor) AS header_id, fecha_emision, razon_social_emisor, CAST(floor(mnt_total) AS DECIMAL(18,2)) AS mnt_total,
    concat_ws(':', tipo_dte, folio, rut_emisor) || '#1' AS line_id, CAST(floor(mnt_neto) AS DECIMAL(18,2)) AS monto_item FROM docs""")


def _loaded(store: Store) -> DataFrame:
    heads = store.read("headers").select("header_id", "fecha_emision", "razon_social_emisor", "mnt_total")
    return heads.join(store.read("lines").select("header_id", "line_id", "monto_item"), "header_id")


@query("folder_load", LOADED)
def folder_load(spark, sf) -> DataFrame:
    """Envelope files loaded from a folder, read as large files are: many tasks per file."""
    work = work_folder(spark, "folder-load")
    write_envelopes(spark, sf, f"{work}/in")
    store = Store(spark, f"{work}/store")
    ingest_folder(store, f"{work}/in", Run(run_id="one", started_at=START), whole_file_bytes=1024, as_of=AS_OF)
    ingest_folder(store, f"{work}/in", Run(run_id="two", started_at=START), whole_file_bytes=1024, as_of=AS_OF)
    return _loaded(store)


@query("stream_load", LOADED)
def stream_load(spark, sf) -> DataFrame:
    """The same envelopes loaded by the file stream, some files per micro-batch."""
    work = work_folder(spark, "stream-load")
    write_envelopes(spark, sf, f"{work}/in")
    store = Store(spark, f"{work}/store")
    stream_ingest(store, f"{work}/in", f"{work}/checkpoint", files_per_batch=6, as_of=AS_OF).awaitTermination()
    discard(spark, f"{work}/in")  # loaded, and larger than all that the join below needs
    return _loaded(store)


@query("two_streams_load", LOADED)
def two_streams_load(spark, sf) -> DataFrame:
    """Two folders loaded into one store by streams of their own, each run twice."""
    work = work_folder(spark, "two-streams")
    store = Store(spark, f"{work}/store")
    for name, only in (("one", "tipo_dte = 39"), ("two", "tipo_dte <> 39")):
        write_envelopes(spark, sf, f"{work}/{name}", only)
        for _ in range(2):
            stream_ingest(store, f"{work}/{name}", f"{work}/checkpoint-{name}", as_of=AS_OF).awaitTermination()
        discard(spark, f"{work}/{name}")
    return _loaded(store)


def event_stream(spark, sf) -> DataFrame:
    """The events, one file or a folder of files; the bracket makes the path a pattern, which takes either."""
    return spark.readStream.schema(SCHEMAS["events"]).parquet(f"{sf}/events.parque[t]")


@query("stream_daily_events", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_daily_events(spark, sf) -> DataFrame:
    """Events per day and type, kept by a stream as one folder per day."""
    work = work_folder(spark, "stream-days")
    upsert_days(daily_counts(event_stream(spark, sf), ["event_type"]), f"{work}/days", f"{work}/checkpoint").awaitTermination()
    return spark.read.schema("event_type string, n bigint, day date").parquet(f"{work}/days")


@query("stream_unique_events", "SELECT event_id, user_id, event_type FROM events")
def stream_unique_events(spark, sf) -> DataFrame:
    """A feed that delivers every event twice, without the repeats."""
    work = work_folder(spark, "stream-unique")
    twice = event_stream(spark, sf).unionByName(event_stream(spark, sf)).select("event_id", "ts", "user_id", "event_type")
    append_to(drop_repeats(twice, ["event_id"]), f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/out").select("event_id", "user_id", "event_type")
