"""Event feeds: duplicate drop with bounded state, daily counts."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioflow.session import discard, work_folder

LATENESS = "1 day"


def _timed(events: DataFrame, ts: str, lateness: str) -> DataFrame:
    # A watermark needs a zoned timestamp.
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def drop_repeats(events: DataFrame, keys: list[str], ts: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Drops events whose keys were seen before, whatever their time; state ends ``lateness`` after an event."""
    return _timed(events, ts, lateness).dropDuplicatesWithinWatermark(keys)


def daily_counts(events: DataFrame, keys: list[str], ts: str = "ts", lateness: str = LATENESS,
                 day_start: str = "0 hours") -> DataFrame:
    """Events per day and key; ``day_start`` shifts midnight to a zone's."""
    day = F.window(ts, "1 day", startTime=day_start)
    counts = _timed(events, ts, lateness).groupBy(day.alias("w"), *keys).agg(F.count("*").alias("n"))
    return counts.select(F.to_date("w.start").alias("day"), *keys, "n")


def written(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends finished rows to Parquet; the file sink commits each batch once."""
    return stream.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def upsert_days(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps one Parquet folder per day up to date, including days still open.

    Update mode hands over the counts that changed, each whole. They are merged into the files of their days, in which they
    replace the rows of the same keys, so a batch that is repeated changes nothing. A day has as many files as its size asks for.
    State is one row per day and key, and ends when the watermark has passed the day.
    """
    keys = [c for c in stream.columns if c != "n"]

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        work = work_folder(spark, "changed-days")
        try:
            changed = written(spark, batch, f"{work}/changed")
            days = [r.day for r in changed.select("day").distinct().collect()]  # those within the lateness
            try:
                kept = spark.read.schema(changed.schema).parquet(path).filter(F.col("day").isin(days))
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
                kept = changed.limit(0)
            new = changed.select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = reduce(and_, [kept[k].eqNullSafe(F.col(f"_{k}")) for k in keys])
            whole = written(spark, kept.join(new, same, "left_anti").unionByName(changed), f"{work}/whole")
            whole.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
        finally:
            discard(spark, work)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).outputMode(
        "update").trigger(availableNow=True).start()
