"""Line item enrichment and the reports over enriched lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.taxonomy import FITTINGS, Taxonomy, code_prefix, item_facts, item_text, item_verdict

ENRICHED = ["ai_category", "ai_subcategory", "ai_brand", "ai_attrs", "ai_confidence", "ai_version"]


def needs_enrichment(version: str, force: bool = False):
    return F.lit(True) if force else ~F.col("ai_version").eqNullSafe(F.lit(version))


def candidates(lines: DataFrame, version: str, force: bool = False, limit: int | None = None) -> DataFrame:
    """Lines not yet stamped with this version; with ``limit`` the newest ids only."""
    found = lines.filter(needs_enrichment(version, force))
    return found if limit is None else found.orderBy(F.desc("line_id")).limit(limit)


def classify(lines: DataFrame, taxonomy: Taxonomy = FITTINGS) -> DataFrame:
    """Every line with the six enrichment columns; narrow, built-in expressions only.

    Text, facts and verdict are layers: each value is computed once and then referred to. The
    verdict leaves a generator, so that a later filter on it does not copy the layers below.
    """
    kept = [c for c in lines.columns if c not in ENRICHED]
    texts = lines.select(
        *kept, item_text(F.col("nombre_item"), F.col("descripcion")).alias("_text"), code_prefix(F.col("codigo")).alias("_prefix"))
    facts = item_facts(taxonomy, F.col("_text"), F.col("_prefix"), F.col("codigo"))
    judged = texts.select(*kept, *[c.alias(f"_{n}") for n, c in facts.items()])
    verdict = item_verdict(taxonomy, {n: F.col(f"_{n}") for n in facts})
    return judged.select(*kept, F.explode(F.array(verdict)).alias("_ai")).select(*kept, "_ai.*")


def enrich(lines: DataFrame, taxonomy: Taxonomy = FITTINGS, force: bool = False) -> DataFrame:
    """All lines, those of another version re-judged, the rest as they were. Narrow: no shuffle."""
    stale = needs_enrichment(taxonomy.version, force)
    kept = [c for c in lines.columns if c not in ENRICHED]
    done = lines.filter(~stale).select(*kept, *ENRICHED)
    return classify(lines.filter(stale), taxonomy).unionByName(done)


# ---- reports ----------------------------------------------------------------------------------

def _mix(lines: DataFrame, keys: list[str], top: int) -> DataFrame:
    grouped = lines.filter(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum("monto_item").cast("decimal(38,2)").alias("rev"))
    return grouped.orderBy(F.desc_nulls_first("rev"), *[F.asc_nulls_first(k) for k in keys]).limit(top)


def category_mix(lines: DataFrame, top: int = 30) -> DataFrame:
    return _mix(lines, ["ai_category", "ai_subcategory"], top)


def brand_ranking(lines: DataFrame, top: int = 20) -> DataFrame:
    return _mix(lines, ["ai_brand"], top)


def unenriched_rate(lines: DataFrame, taxonomy: Taxonomy = FITTINGS) -> DataFrame:
    """Percent of lines without category, and percent the classifier could not place."""
    def percent(test):
        share = F.count_if(test) * F.lit(100.0) / F.greatest(F.count("*"), F.lit(1))
        return F.round(share, 2).cast("decimal(5,2)")

    category = F.col("ai_category")
    return lines.agg(
        F.count("*").alias("lines"),
        percent(category.isNull()).alias("unenriched_rate"),
        percent(F.coalesce(category == taxonomy.unclassified, F.lit(False))).alias("unclassified_rate"))


def subcategory_pairs(lines: DataFrame, *, min_count: int = 3, top: int | None = 20, include_self: bool = True,
                      column: str = "ai_subcategory") -> DataFrame:
    """(s1, s2, n): how often two lines of one document carry these subcategories.

    A document's lines shrink to one count per subcategory, before and after one shuffle; only its distinct names
    are then joined with each other. n(s1, s2) is the sum over documents of count(s1) * count(s2), or
    n * (n - 1) / 2 for s1 = s2. A document with a third of all lines is as many rows as it has names, and every name
    in the data counts.
    """
    own = lines.filter(F.col(column).isNotNull()).groupBy("header_id", F.col(column).alias("s1")).agg(F.count("*").cast("decimal(19,0)").alias("n1"))
    other = own.select("header_id", F.col("s1").alias("s2"), F.col("n1").alias("n2"))
    both = own.join(other, "header_id").filter("s1 <= s2" if include_self else "s1 < s2")
    n = F.when(F.col("s1") == F.col("s2"), F.floor(F.col("n1") * (F.col("n1") - 1) / 2)).otherwise(F.col("n1") * F.col("n2"))
    pairs = both.groupBy("s1", "s2").agg(F.sum(n.cast("decimal(38,0)")).cast("decimal(38,0)").alias("n"))
    kept = pairs.filter(F.col("n") >= min_count)
    return kept if top is None else kept.orderBy(F.desc("n"), "s1", "s2").limit(top)
