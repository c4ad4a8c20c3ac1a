"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.session import work_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: white space (blank and \t \n \v \f \r), or all ASCII but letters and digits.
SPACED = r"[\x20\x09-\x0D]+"
ALNUM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The most rows of a small table that are sent to every executor; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` as a Parquet table in the cluster's shared folder: cuts lineage, survives lost executors."""
    spark = rows.sparkSession
    path = work_folder(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def small(rows: DataFrame, limit: int = BROADCAST_ROWS, arrays: str | None = None) -> DataFrame:
    """``rows``, a written table, marked for broadcast if it is counted and found small: entries of the column ``arrays`` count as a row each."""
    if arrays is None:
        return F.broadcast(rows) if rows.count() <= limit else rows
    entries = rows.agg(F.coalesce(F.sum(F.size(arrays) + 1), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(rows) if entries <= limit else rows


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. ``lower`` does the same, faster, where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column, between: str = SPACED) -> Column:
    """All words of the whole text, the runs of characters that are not ``between``; none of null.

    Splitting is some 15 times faster than extracting every match.
    """
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def indices(n: Column) -> Column:
    """[0, n), empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def crc_of(column: str) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def in_batches(rows: DataFrame, run: Callable, schema: str, records: int = 1000) -> DataFrame:
    """``mapInArrow`` over batches of at most ``records`` rows.

    A batch of whole texts must fit into a Python worker several times over; Spark's own limit of 10,000 rows is made for
    short rows. The limit is a session setting, lowered here if it is higher and never raised.
    """
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= records:
        conf.set(name, str(records))
    task, root = cloudpickle.dumps(run), str(Path(__file__).resolve().parents[2])

    def there(batches):
        # Workers of a local session started elsewhere do not have this package on their path.
        if root not in sys.path:
            sys.path.append(root)
        yield from pickle.loads(task)(batches)

    return rows.mapInArrow(there, schema)
