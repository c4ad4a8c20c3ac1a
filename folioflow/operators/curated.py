"""Curated star schema: facts, dimensions, daily aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators.quality import (
    Limits, amount_differs, bad_quantity_or_price, line_flags, with_owner, with_rules,
)

HEADER_SIDE = ["fecha_emision", "tipo_dte", "folio", "rut_emisor", "razon_social_emisor",
               "rut_receptor", "razon_social_receptor"]
LINE_SIDE = ["nro_linea", "tipo_codigo", "codigo", "nombre_item", "descripcion",
             "cantidad", "precio_unitario", "monto_item"]
TOTALS = ["mnt_neto", "iva", "mnt_total"]


def line_detail(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Every line beside its document, 20 columns."""
    joined = lines.join(headers, "header_id")
    return joined.select("header_id", *HEADER_SIDE, *TOTALS, F.col("line_id").alias("detail_id"), *LINE_SIDE)


def fact_lines(headers: DataFrame, lines: DataFrame, violations: DataFrame, rules: DataFrame) -> DataFrame:
    """Every line beside its document with its data-quality flags, 22 columns.

    Flags are one row per line before the join; lines without violations get False. Where the
    violations carry their document, the join on (document, line) reuses the lines' partitioning
    by document, and the wide rows are shuffled once. For that they meet their headers, too, by the id as violations spell it.
    """
    flags = line_flags(violations, rules)
    document = F.col("l.header_id").cast("string")
    heads = headers.withColumn("_document", F.col("header_id").cast("string")).drop("header_id")
    same = F.col("f.line_id") == F.col("l.line_id").cast("string")
    if "header_id" in flags.columns:
        same = (F.col("f.header_id") == document) & same
    joined = lines.alias("l").join(heads, F.col("_document") == document).join(flags.alias("f"), same, "left")
    return joined.select(
        "l.header_id", F.col("l.line_id").alias("detail_id"), *HEADER_SIDE, *LINE_SIDE, *TOTALS,
        F.coalesce("dq_has_error", F.lit(False)).alias("dq_has_error"),
        F.coalesce("dq_has_warn", F.lit(False)).alias("dq_has_warn"))


def flagged_line_totals(headers: DataFrame, lines: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per day and type: lines, amounts, and how many lines break an ERROR or a WARN rule.

    Rules are judged inside the line scan and lines are added up per document before the join, so
    the join meets at most one row per document and no violation table is built.
    """
    per_document = lines.groupBy("header_id").agg(
        F.count("*").alias("n_lines"), F.sum("monto_item").alias("amount"),
        F.count_if(bad_quantity_or_price(limits)).alias("n_error"), F.count_if(amount_differs(limits)).alias("n_warn"))
    return headers.select("header_id", "fecha_emision", "tipo_dte").join(per_document, "header_id").groupBy(
        "fecha_emision", "tipo_dte").agg(
        F.sum("n_lines").alias("n_lines"), F.sum("amount").cast("decimal(38,2)").alias("monto_total"),
        F.sum("n_error").alias("n_error"), F.sum("n_warn").alias("n_warn"))


def violations_enriched(violations: DataFrame, rules: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Violations with rule and owning document; ``lines`` is needed only where the owner is not stored."""
    owned = violations if lines is None else with_owner(violations, lines)
    return with_rules(owned, rules)


def _dimension(headers: DataFrame, key: str, name: str) -> DataFrame:
    return headers.groupBy(key).agg(F.max(name).alias(name))


def dim_issuer(headers: DataFrame) -> DataFrame:
    return _dimension(headers, "rut_emisor", "razon_social_emisor")


def dim_receiver(headers: DataFrame) -> DataFrame:
    return _dimension(headers, "rut_receptor", "razon_social_receptor")


def _documents_and_amount(headers: DataFrame, keys: list[str | Column], n: str) -> DataFrame:
    return headers.groupBy(*keys).agg(
        F.count("*").alias(n), F.sum("mnt_total").cast("decimal(38,2)").alias("monto_total"))


def daily_totals(headers: DataFrame) -> DataFrame:
    return _documents_and_amount(headers, ["fecha_emision", "tipo_dte", "rut_emisor"], "n_docs")


def daily_kpi(headers: DataFrame) -> DataFrame:
    return _documents_and_amount(headers, [F.to_date("fecha_emision").alias("dia")], "dtes").orderBy(
        F.asc_nulls_last("dia"))


def type_stats(headers: DataFrame) -> DataFrame:
    return _documents_and_amount(headers, ["tipo_dte"], "n").withColumnRenamed("monto_total", "monto").orderBy(
        F.asc_nulls_last("tipo_dte"))
