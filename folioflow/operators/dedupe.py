"""First occurrence wins, already loaded documents, and the reject lane."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.schema import BUSINESS_KEY, HEADER_REQUIRED, HEADER_TEXT_LIMITS, LINE_TEXT_LIMITS


def elected(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, order) of the first row of each key. NULL keys are equal, as in GROUP BY.

    An aggregate, not a window: each task keeps one row per key before the shuffle, so a key that
    holds a third of all rows costs one row per task. Only keys and order are read.
    """
    return df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first")).select(*keys, "_first.*")


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``, which must tell the rows of a key apart.

    Two phases: an election among keys and order, then the elected rows are fetched by a semi join. Other columns are in no
    aggregate and in no sort; they move once, dealt by key and order, so that a hot key is spread.
    """
    return matching(df, elected(df, keys, order).hint("shuffle_hash"), list(dict.fromkeys([*keys, *order])), "left_semi")


def matching(df: DataFrame, others: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Rows of ``df`` that have an equal among ``others`` (``left_semi``), or none (``left_anti``). NULLs are equal."""
    renamed = others.select(*[F.col(c).alias(f"_{c}") for c in columns])
    return df.join(renamed, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]), how)


def present_keys(new: DataFrame, stored: DataFrame, keys: list[str] = BUSINESS_KEY) -> DataFrame:
    """Keys of ``new`` that ``stored`` already has.

    ``stored`` grows without end, so it is the streamed side: only its key columns are read, and
    while ``new`` is small its keys are broadcast and history is not shuffled.
    """
    return stored.select(*keys).join(new.select(*keys), keys, "left_semi").distinct()


def only_new(new: DataFrame, stored: DataFrame, keys: list[str] = BUSINESS_KEY) -> DataFrame:
    """Documents not stored yet."""
    return new.join(present_keys(new, stored, keys), keys, "left_anti")


def _too_long(row: Column | None, limits: dict[str, int]) -> Column:
    def field(name: str) -> Column:
        return F.col(name) if row is None else row.getField(name)
    return reduce(or_, [F.coalesce(F.length(field(c)) > n, F.lit(False)) for c, n in limits.items()])


def reject_reason(lines: str | None = "lines", required: list[str] = HEADER_REQUIRED) -> Column:
    """Why a parsed document cannot be stored, or NULL.

    Line checks look into the document's own line array, so they need no shuffle.
    """
    reason = F.lit(None).cast("string")
    for name in reversed(required):
        reason = F.when(F.col(name).isNull(), F.lit(f"missing {name}")).otherwise(reason)
    checks = F.when(reason.isNotNull(), reason).when(_too_long(None, HEADER_TEXT_LIMITS), "header text too long")
    if lines:
        numbers = F.filter(F.transform(F.col(lines), lambda d: d.getField("nro_linea")), lambda n: n.isNotNull())
        checks = checks.when(
            F.exists(F.col(lines), lambda d: _too_long(d, LINE_TEXT_LIMITS)), "line text too long"
        ).when(F.size(F.array_distinct(numbers)) < F.size(numbers), "repeated nro_linea")
    return checks


def repeated_lines(lines: DataFrame, header: str = "header_id", number: str = "nro_linea") -> DataFrame:
    """(header, line number) pairs that occur more than once in a flat line table."""
    counts = lines.filter(F.col(number).isNotNull()).groupBy(header, number).agg(F.count("*").alias("n"))
    return counts.filter("n > 1")


def split_rejects(parsed: DataFrame, scope: str = "document", required: list[str] = HEADER_REQUIRED) -> tuple[DataFrame, DataFrame]:
    """(storable, rejected with reason). ``scope='file'``: one bad document rejects its whole file."""
    return split_judged(parsed.withColumn("reason", reject_reason(required=required)), scope)


def split_judged(judged: DataFrame, scope: str = "document") -> tuple[DataFrame, DataFrame]:
    """The same for documents that carry their ``reason``."""
    if scope == "document":
        return judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL")
    if scope != "file":
        raise ValueError("scope is 'document' or 'file'")
    spoiled = judged.filter("reason IS NOT NULL").groupBy("file").agg(F.min("reason").alias("_file_reason"))
    marked = judged.join(spoiled, "file", "left")
    bad = marked.filter("_file_reason IS NOT NULL")
    kept = marked.filter("_file_reason IS NULL").drop("reason", "_file_reason")
    rejected = bad.withColumn("reason", F.coalesce("reason", F.concat(F.lit("file: "), "_file_reason")))
    return kept, rejected.drop("_file_reason")
