"""Cross-table checks: missing lines, orphans, duplicates, totals, inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.schema import BUSINESS_KEY

SAMPLE = 50


def headers_without_lines(headers: DataFrame, lines: DataFrame) -> DataFrame:
    # One row per document goes through the shuffle, however many lines it has.
    return headers.join(lines.select("header_id").distinct(), "header_id", "left_anti")


def orphan_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    return lines.join(headers.select("header_id"), "header_id", "left_anti")


def duplicate_keys(headers: DataFrame, keys: list[str] = BUSINESS_KEY) -> DataFrame:
    return headers.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def line_sums(lines: DataFrame) -> DataFrame:
    return lines.groupBy("header_id").agg(F.sum("monto_item").alias("sumdet"))


def totals_mismatch(headers: DataFrame, lines: DataFrame, tolerance: float = 1, compare_to: str = "mnt_total") -> DataFrame:
    """Documents whose lines do not add up to ``compare_to`` within the tolerance.

    Lines are net while the total is gross: ``compare_to='mnt_neto'`` gives the like-for-like check.
    Lines are summed per document before the join.
    """
    money = F.lit(0).cast("decimal(28,2)")
    joined = headers.select("header_id", F.col(compare_to).alias("mnt_total")).join(line_sums(lines), "header_id", "left")
    total, summed = F.coalesce("mnt_total", money), F.coalesce("sumdet", money)
    return joined.filter(F.abs(total - summed) > tolerance).select(
        "header_id", total.cast("decimal(28,2)").alias("mnt_total"), summed.cast("decimal(28,2)").alias("sumdet"))


def _count(df: DataFrame, metric: str) -> DataFrame:
    return df.agg(F.count("*").alias("value")).select(F.lit(metric).alias("metric"), "value")


def inventory(files: DataFrame, headers: DataFrame, lines: DataFrame, violations: DataFrame) -> DataFrame:
    """(metric, value) sizes of the store."""
    return reduce(DataFrame.unionByName, [
        _as_rows(files.agg(F.count_distinct("file_id").alias("files.total"))),
        _as_rows(headers.agg(F.count_distinct("file_id").alias("files.with_headers"), F.count("*").alias("headers.total"))),
        _count(lines, "details.total"),
        _count(violations, "dq.violations_total"),
    ])


def _as_rows(wide: DataFrame) -> DataFrame:
    """One row of named counts as (metric, value) rows."""
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").alias("value")) for c in wide.columns])))


def unparsed_files(files: DataFrame, headers: DataFrame) -> DataFrame:
    """Registered files no document came from.

    The join asks only whether there is a document, so their ids are not made distinct before: that would hold all ids of a task in memory.
    """
    return files.join(headers.select("file_id"), "file_id", "left_anti")


def backlog(files: DataFrame, headers: DataFrame) -> DataFrame:
    """How many registered files have no document: distinct file ids, retried files once, less those of documents."""
    registered = files.agg(F.count_distinct("file_id").alias("n"))
    parsed = headers.agg(F.count_distinct("file_id").alias("n"))
    signed = registered.select("n").unionByName(parsed.select((-F.col("n")).alias("n")))
    return signed.agg(F.sum("n").alias("backlog_unparsed_files"))


def consistency_report(files: DataFrame, headers: DataFrame, lines: DataFrame, violations: DataFrame,
                       rules: DataFrame, tolerance: float = 1, compare_to: str = "mnt_total") -> DataFrame:
    """(metric, value): inventory and all check counts; true counts, not capped at a sample.

    Lines shrink to one row per document, and one full outer join with the documents then answers
    all questions between the two tables.
    """
    from folioflow.operators.quality import with_rules

    zero = F.lit(0).cast("decimal(28,2)")
    per_document = lines.groupBy("header_id").agg(F.sum("monto_item").alias("sumdet"), F.count("*").alias("n_lines"))
    known = headers.select("header_id", F.col(compare_to).alias("total"), F.lit(True).alias("known"))
    both = known.join(per_document, "header_id", "full_outer")
    gap = F.abs(F.coalesce("total", zero) - F.coalesce("sumdet", zero))
    checks = both.agg(
        F.count("known").alias("headers.total"),
        F.count_if(F.col("n_lines").isNull()).alias("headers.without_details"),
        F.coalesce(F.sum("n_lines"), F.lit(0)).alias("details.total"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n_lines"))), F.lit(0)).alias("details.orphans"),
        F.count_if(F.col("known") & (gap > tolerance)).alias("totals_check.mismatch_count"))
    per_rule = violations.groupBy("rule_id").agg(F.count("*").alias("n"))
    return reduce(DataFrame.unionByName, [
        _as_rows(files.agg(F.count_distinct("file_id").alias("files.total"))),
        headers.agg(F.count_distinct("file_id").alias("value")).select(F.lit("files.with_headers").alias("metric"), "value"),
        _as_rows(checks),
        _count(duplicate_keys(headers), "headers.duplicate_groups_count"),
        per_rule.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("value")).select(F.lit("dq.violations_total").alias("metric"), "value"),
        with_rules(per_rule, rules).groupBy(F.concat(F.lit("dq.by_level."), "rule_level").alias("metric")).agg(F.sum("n").alias("value")),
    ])


def duplicate_sample(headers: DataFrame, limit: int = SAMPLE) -> DataFrame:
    return duplicate_keys(headers).orderBy(F.desc("n"), *BUSINESS_KEY).limit(limit)


def mismatch_sample(headers: DataFrame, lines: DataFrame, tolerance: float = 1, limit: int = SAMPLE) -> DataFrame:
    return totals_mismatch(headers, lines, tolerance).orderBy("header_id").limit(limit)
