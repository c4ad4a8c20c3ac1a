"""Token counts by source, language and tokenizer version, kept up by signed deltas.

A batch of changes says, for each document, what it is worth now and what it was worth before: an insert has no
before, a delete no after, a revision both. It becomes one row of signed sums per (source, lang, version), summed before and
after the shuffle, so that a hot source costs no task more than its own partial sums. A batch writes one partition
of the delta table, by dynamic overwrite: committing it again, after a lost driver or by mistake, replaces the same rows and
adds nothing. Totals are sums over committed partitions; a batch that was not committed is not seen.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.common import ALNUM, SPACED, words

KEYS = ["source", "lang", "version"]
DELTAS = "source string, lang string, version string, docs bigint, tokens bigint, batch string"
#: Tokenizer versions that need no vocabulary, by name.
VERSIONS = {"spaced-1": SPACED, "alnum-1": ALNUM}


def count(text: Column, version: str) -> Column:
    """Tokens of the whole text; 0 for null and empty texts."""
    return F.size(words(text, VERSIONS[version])).cast("long")


def inserted(docs: DataFrame, version: str) -> DataFrame:
    """Changes that add every row of ``docs``, repeated rows included. Null sources and languages are groups of their own."""
    return docs.select("source", "lang", F.lit(version).alias("version"), F.lit(None).cast("long").alias("before"), count(F.col("text"), version).alias("after"))


def deleted(docs: DataFrame, version: str) -> DataFrame:
    return inserted(docs, version).select(*KEYS, F.col("after").alias("before"), F.lit(None).cast("long").alias("after"))


def revised(docs: DataFrame, version: str, before: Column, after: Column) -> DataFrame:
    """Changes of the count of documents that stay in their group."""
    return docs.select("source", "lang", F.lit(version).alias("version"), before.cast("long").alias("before"), after.cast("long").alias("after"))


class Rollup:
    """The delta table in one folder. Batches may be committed in any order, and by any number of writers with different names."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Adds a batch, or replaces what was committed under its name. One without changes leaves an all-zero row."""
        is_doc = lambda c: F.col(c).isNotNull().cast("long")
        sums = changes.groupBy(*KEYS).agg(F.sum(is_doc("after") - is_doc("before")).alias("docs"),
                                          F.sum(F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0))).alias("tokens"))
        mark = self.spark.range(1).select(*[F.lit(None).cast("string").alias(k) for k in KEYS], F.lit(0).cast("long").alias("docs"), F.lit(0).cast("long").alias("tokens"))
        sums = sums.union(mark).withColumn("batch", F.lit(batch))
        sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.folder)

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) of groups that hold documents; none before the first commit."""
        try:
            deltas = self.spark.read.schema(DELTAS).parquet(self.folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            deltas = self.spark.createDataFrame([], DELTAS)
        return deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 OR tokens <> 0")
