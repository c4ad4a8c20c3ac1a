"""Star-schema tables read in the roles of documents, lines, runs and audit events.

Each role projects what it needs, so Parquet reads only those columns, and joins a party or item
table only when the caller asks for its names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.scalars import run_status
from folioflow.session import spread


# Declared, so that opening a table starts no job to read its footer.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str, dealt: bool = False) -> DataFrame:
    """A table; ``dealt`` spreads a small one over all cores before costly work on its rows."""
    rows = spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
    return spread(rows) if dealt else rows


def documents(spark: SparkSession, folder: str, parties: bool = False, dealt: bool = False) -> DataFrame:
    """Orders as documents; with ``parties`` the customer is the issuer and the nation the receiver."""
    money = F.col("o_totalprice").cast("decimal(18,2)")
    net = (money * F.lit("0.84").cast("decimal(3,2)")).cast("decimal(18,2)")
    orders = table(spark, folder, "orders", dealt).select(
        F.col("o_orderkey").alias("header_id"), F.col("o_orderkey").alias("file_id"),
        F.when(F.col("o_orderstatus") == "F", 33).when(F.col("o_orderstatus") == "O", 39).otherwise(61).alias("tipo_dte"),
        F.col("o_orderkey").alias("folio"), F.to_date("o_orderdate").alias("fecha_emision"),
        F.col("o_custkey").cast("string").alias("rut_emisor"),
        net.alias("mnt_neto"), (money - net).cast("decimal(18,2)").alias("iva"), money.alias("mnt_total"),
        F.col("o_custkey"))
    if not parties:
        return orders.drop("o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        *[c for c in orders.columns if c != "o_custkey"], F.col("c_name").alias("razon_social_emisor"),
        F.col("c_nationkey").cast("string").alias("rut_receptor"), F.col("n_name").alias("razon_social_receptor"))


def line_id() -> Column:
    """The id of a line item, spelled from its columns, because line numbers repeat within an order.

    A numbering would need all lines of an order in one task.
    """
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)


def lines(spark: SparkSession, folder: str, items: bool = True, dealt: bool = False) -> DataFrame:
    """Line items as document lines; ``items`` adds what the part table knows."""
    rows = table(spark, folder, "lineitem", dealt).select(
        line_id().alias("line_id"), F.col("l_orderkey").alias("header_id"), F.col("l_linenumber").alias("nro_linea"),
        F.col("l_returnflag").alias("tipo_codigo"), F.col("l_quantity").cast("decimal(18,6)").alias("cantidad"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("monto_item"), "l_partkey")
    if not items:
        return rows.drop("l_partkey")
    parts = table(spark, folder, "part").select(
        "p_partkey", F.col("p_name").alias("nombre_item"), F.col("p_brand").alias("codigo"),
        F.col("p_type").alias("descripcion"), F.col("p_retailprice").cast("decimal(18,6)").alias("precio_unitario"))
    return rows.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").drop("l_partkey", "p_partkey")


def audit_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as audit entries, times as stored (UTC)."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.col("ts"), F.col("user_id").cast("string").alias("user"),
        F.concat(F.lit("/action/"), kind).alias("path"),
        F.when(kind.isin("view", "click"), "GET").otherwise("POST").alias("method"),
        F.when(kind == "error", 500).otherwise(200).alias("status"), kind.alias("action"), F.col("props").alias("extra"))


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """One run per user and UTC day of the events, with counters from the event types."""
    kind = F.col("event_type")
    grouped = table(spark, folder, "events").groupBy(F.col("user_id"), F.to_date("ts").alias("d")).agg(
        F.min("ts").alias("started_at"), F.nullif(F.max("ts"), F.min("ts")).alias("ended_at"),
        F.count("*").alias("files_total"), F.count_if(kind == "error").alias("files_failed"),
        F.count_if(kind.isin("view", "click", "purchase")).alias("headers_inserted"),
        F.sum(F.floor("value")).cast("bigint").alias("details_inserted"),
        F.count_if((kind == "signup") & (F.col("value") > 25)).alias("dq_violations"),
        F.max(F.col("value") > 150).alias("crashed"), F.min(kind).alias("source"),
        F.max(kind).alias("last_kind"))
    return grouped.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("d", "yyyyMMdd")).alias("run_id"),
        F.when(F.col("last_kind") == "view", "etl_daily").otherwise("manual_parse").alias("job"), "source",
        "started_at", "ended_at", run_status(F.col("crashed"), F.col("files_failed"), F.lit(0)).alias("status"),
        "files_total", (F.col("files_total") - F.col("files_failed")).alias("files_ok"), "files_failed",
        "headers_inserted", "details_inserted", "dq_violations")


def registered_files(spark: SparkSession, folder: str) -> DataFrame:
    """One registered file per order, and per page, which no document came from."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("file_id"), F.concat(F.lit("F"), "o_orderkey", F.lit(".xml")).alias("filename"),
        F.col("o_orderdate").alias("created_at"))
    pages = table(spark, folder, "pages").select(
        (-F.col("page_id") - 1).alias("file_id"), F.concat(F.lit("P"), "page_id", F.lit(".xml")).alias("filename"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"))
    return orders.unionByName(pages)
