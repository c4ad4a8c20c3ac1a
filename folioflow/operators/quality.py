"""Data-quality rules, violations, their counts, and the alert condition."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.scalars import LOCAL_ZONE, local_day, per_hundred
from folioflow.operators.consistency import totals_mismatch
from folioflow.schema import RULE_CATALOGUE, rule_catalogue

MESSAGES = {code: text for _, code, _, _, text in RULE_CATALOGUE}


@dataclass(frozen=True)
class Limits:
    """Rule thresholds; the defaults are the published ones."""

    max_bad_quantity: float = 0
    amount_gap: float = 1
    first_day: str = "2000-01-01"
    days_ahead: int = 1


def bad_quantity_or_price(limits: Limits = Limits()) -> Column:
    """DQ1: quantity not above the floor (NULL counts as 0), or a negative price."""
    zero = F.lit(0)
    return (F.coalesce("cantidad", zero) <= limits.max_bad_quantity) | (F.coalesce("precio_unitario", zero) < 0)


def amount_differs(limits: Limits = Limits()) -> Column:
    """DQ2: line amount away from quantity times price by more than the gap."""
    zero = F.lit(0).cast("decimal(18,6)")
    product = F.coalesce("cantidad", zero) * F.coalesce("precio_unitario", zero)
    return F.abs(F.coalesce("monto_item", zero) - product) > limits.amount_gap


def day_out_of_range(as_of: date, limits: Limits = Limits()) -> Column:
    """DQ4: issued before the first plausible day or after tomorrow; NULL passes."""
    day = F.col("fecha_emision")
    last = F.date_add(F.lit(as_of).cast("date"), limits.days_ahead)
    return F.coalesce((day < F.lit(limits.first_day).cast("date")) | (day > last), F.lit(False))


def line_rules(limits: Limits = Limits()) -> dict[str, Column]:
    return {"DQ1": bad_quantity_or_price(limits), "DQ2": amount_differs(limits)}


def header_rules(as_of: date, limits: Limits = Limits()) -> dict[str, Column]:
    return {"DQ4": day_out_of_range(as_of, limits)}


def broken_rules(rows: DataFrame, rules: dict[str, Column], *keep: Column) -> DataFrame:
    """One row per rule a row breaks: ``keep`` and ``rule_code``. All rules share the scan."""
    codes = F.array(*[F.when(p, F.lit(code)) for code, p in rules.items()])
    return rows.select(*keep, F.explode(codes).alias("rule_code")).filter(F.col("rule_code").isNotNull())


def _violations(broken: DataFrame, catalogue: DataFrame, entity: str, run_id: str | None, created_at) -> DataFrame:
    messages = F.create_map(*[F.lit(x) for pair in MESSAGES.items() for x in pair])
    rules = catalogue.filter(F.col("entity") == entity).select("rule_id", "rule_code")
    # A code that a given catalogue lacks yields nothing.
    found = broken.join(rules, "rule_code")
    run = F.lit(run_id).cast("string")
    return found.select(
        F.concat_ws(":", F.coalesce(run, F.lit("")), "rule_code", "entity_id").alias("violation_id"),
        run.alias("run_id"), "rule_id", F.lit(entity).alias("entity"),
        "entity_id", "header_id", F.element_at(messages, F.col("rule_code")).alias("message"),
        F.lit(created_at).cast("timestamp").alias("created_at"),
    )


def find_violations(headers: DataFrame, lines: DataFrame, *, as_of: date, run_id: str | None = None,
                    rules: DataFrame | None = None, limits: Limits = Limits(), created_at=None,
                    check_totals: bool = False) -> DataFrame:
    """Every rule over one scan of each table; no shuffle unless ``check_totals`` adds DQ3.

    Rows carry the owning document, so later reports need not look it up.
    """
    catalogue = F.broadcast(rule_catalogue(headers.sparkSession)) if rules is None else bounded_rules(rules)
    owner = F.col("header_id").cast("string")
    line_hits = broken_rules(
        lines, line_rules(limits), F.col("line_id").cast("string").alias("entity_id"), owner.alias("header_id"))
    header_hits = broken_rules(headers, header_rules(as_of, limits), owner.alias("entity_id"), owner.alias("header_id"))
    if check_totals:
        off = totals_mismatch(headers, lines, tolerance=limits.amount_gap)
        header_hits = header_hits.unionByName(
            off.select(owner.alias("entity_id"), owner.alias("header_id"), F.lit("DQ3").alias("rule_code")))
    return _violations(line_hits, catalogue, "detail", run_id, created_at).unionByName(
        _violations(header_hits, catalogue, "header", run_id, created_at))


#: The most rules that are sent to every task; a larger table is shuffled.
MAX_RULES = 10_000


def bounded_rules(rules: DataFrame) -> DataFrame:
    """The rule table, marked for broadcast if it is counted and small enough."""
    few = rules.select(F.lit(1)).limit(MAX_RULES + 1).count() <= MAX_RULES
    return F.broadcast(rules) if few else rules


def rule_results(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule_code, passed, failed) for all rules in one scan."""
    counts = rows.agg(
        F.count("*").alias("n"), *[F.count_if(F.coalesce(p, F.lit(False))).alias(code) for code, p in rules.items()])
    each = F.array(*[
        F.struct(F.lit(code).alias("rule_code"), (F.col("n") - F.col(code)).alias("passed"), F.col(code).alias("failed"))
        for code in rules])
    return counts.select(F.inline(each))


# ---- joins over stored violations -------------------------------------------------------------

def with_rules(violations: DataFrame, rules: DataFrame) -> DataFrame:
    """Violations with code and level of their rule."""
    return violations.join(bounded_rules(rules.select("rule_id", "rule_code", "rule_level")), "rule_id")


def with_owner(violations: DataFrame, lines: DataFrame) -> DataFrame:
    """Violations with the document they belong to: the header itself, or the line's header.

    For tables that do not carry ``header_id``. Header rows skip the join altogether; an unknown
    line keeps its violation with a NULL owner.
    """
    bare = violations.drop("header_id")
    on_headers = bare.filter("entity <> 'detail'").withColumn("header_id", F.col("entity_id"))
    owner = lines.select(F.col("line_id").cast("string").alias("entity_id"),
                         F.col("header_id").cast("string").alias("header_id"))
    on_lines = bare.filter("entity = 'detail'").join(owner, "entity_id", "left")
    return on_headers.unionByName(on_lines)


def of_documents(violations: DataFrame, documents: DataFrame) -> DataFrame:
    """Violations whose owning document is in ``documents``."""
    ids = documents.select(F.col("header_id").cast("string").alias("header_id"))
    return violations.join(ids, "header_id", "left_semi")


def lines_of_documents(lines: DataFrame, documents: DataFrame) -> DataFrame:
    return lines.join(documents.select("header_id"), "header_id", "left_semi")


def line_flags(violations: DataFrame, rules: DataFrame) -> DataFrame:
    """(line_id, dq_has_error, dq_has_warn), both flags from one pass over the violations.

    With the owning document where the violations carry it, so that a join can use its partitioning.
    """
    level = F.col("rule_level")
    keys = [F.col("entity_id").alias("line_id")]
    if "header_id" in violations.columns:
        keys.insert(0, F.col("header_id"))
    return with_rules(violations.filter("entity = 'detail'"), rules).groupBy(*keys).agg(
        F.bool_or(level == "ERROR").alias("dq_has_error"), F.bool_or(level == "WARN").alias("dq_has_warn"))


# ---- counts -----------------------------------------------------------------------------------

def by_level(violations: DataFrame, rules: DataFrame) -> DataFrame:
    return _count_by(violations, rules, "rule_level")


def by_rule(violations: DataFrame, rules: DataFrame) -> DataFrame:
    return _count_by(violations, rules, "rule_code")


def _count_by(violations: DataFrame, rules: DataFrame, column: str) -> DataFrame:
    # Counted per rule id first: the join then meets one row per rule.
    counts = violations.groupBy("rule_id").agg(F.count("*").alias("c"))
    return with_rules(counts, rules).groupBy(column).agg(F.sum("c").alias("n"))


def by_day(violations: DataFrame, zone: str = LOCAL_ZONE, stored_zone: str | None = None) -> DataFrame:
    day = local_day(F.col("created_at"), zone, stored_zone)
    return violations.groupBy(day.alias("day")).agg(F.count("*").alias("n")).orderBy(F.asc_nulls_last("day"))


def quality_summary(violations: DataFrame, rules: DataFrame, zone: str = LOCAL_ZONE,
                    stored_zone: str | None = None) -> DataFrame:
    """(section, item, n): counts by level, by rule and by day from one scan of the violations.

    The scan shrinks to one row per (rule, day) before anything else happens.
    """
    day = local_day(F.col("created_at"), zone, stored_zone)
    small = with_rules(violations.groupBy("rule_id", day.alias("day")).agg(F.count("*").alias("c")), rules)
    sections = F.array(
        F.struct(F.lit("by_level").alias("section"), F.col("rule_level").alias("item")),
        F.struct(F.lit("by_rule").alias("section"), F.col("rule_code").alias("item")),
        F.struct(F.lit("by_day").alias("section"), F.col("day").cast("string").alias("item")),
    )
    return small.select("c", F.inline(sections)).groupBy("section", "item").agg(F.sum("c").alias("n"))


def violations_per_hundred(violations: DataFrame, runs: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Violations of each run per 100 lines it loaded, with the alert flag."""
    counts = violations.groupBy("run_id").agg(F.count("*").alias("violations"))
    rate = per_hundred(F.coalesce("violations", F.lit(0)), F.col("details_inserted"))
    joined = runs.select("run_id", "details_inserted").join(counts, "run_id", "left")
    return joined.select(
        "run_id", F.coalesce("violations", F.lit(0)).alias("violations"),
        F.greatest(F.coalesce("details_inserted", F.lit(0)), F.lit(1)).cast("bigint").alias("lines"),
        F.round(rate, 4).cast("decimal(18,4)").alias("viol_x_100"), (rate >= threshold).alias("alert"))
