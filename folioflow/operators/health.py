"""Daily health, its trend, run statistics, service snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.scalars import LOCAL_ZONE, health_score, local_day, run_status, score_band, seconds_between, within_days
from folioflow.operators.consistency import backlog

DAILY_JOB = "etl_daily"
TREND_DAYS = 30


def daily_health(runs: DataFrame, job: str = DAILY_JOB, zone: str = LOCAL_ZONE,
                 stored_zone: str | None = None, day: date | None = None) -> DataFrame:
    """(day, headers, details, violations_total, score), one row per local day of the runs.

    With ``day`` exactly that day, with zero counts and score 100 where no run started.
    """
    started = runs.filter(F.col("job") == job).withColumn("day", local_day(F.col("started_at"), zone, stored_zone))

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    sums = [total("headers_inserted").alias("headers"), total("details_inserted").alias("details"),
            total("dq_violations").alias("violations_total")]
    if day is None:
        counts = started.groupBy("day").agg(*sums)
    else:
        on_day = started.filter(within_days(F.col("started_at"), day, day, zone, stored_zone))
        counts = on_day.agg(*sums).select(F.lit(day).cast("date").alias("day"), "*")
    return counts.withColumn("score", health_score(F.col("violations_total"), F.col("headers")))


def last_days(health: DataFrame, days: int = TREND_DAYS) -> DataFrame:
    return health.orderBy(F.desc_nulls_last("day")).limit(days)


def health_trend(health: DataFrame, days: int = TREND_DAYS) -> DataFrame:
    """The last days with moving means over 7 and 30 rows, day-over-day change and band.

    The windows are unpartitioned and see at most ``days`` rows: the limit comes first.
    """
    by_day = Window.orderBy("day")

    def mean_of_last(n: int) -> Column:
        return F.round(F.avg("score").over(by_day.rowsBetween(1 - n, 0)), 2).cast("decimal(5,2)")

    return last_days(health, days).select(
        "day", "headers", "details", "violations_total", "score",
        mean_of_last(7).alias("avg7"), mean_of_last(30).alias("avg30"),
        (F.col("score") - F.lag("score").over(by_day)).cast("decimal(5,2)").alias("delta1"),
        score_band(F.col("score")).alias("band"))


def best_and_worst_day(health: DataFrame, days: int = TREND_DAYS) -> DataFrame:
    """Highest and lowest score of the last days; among equals the latest day."""
    age = -F.datediff("day", F.lit("1970-01-01").cast("date"))
    picked = last_days(health, days).agg(
        F.max_by(F.struct("day", "score"), F.struct("score", "day")).alias("best"),
        F.min_by(F.struct("day", "score"), F.struct(F.col("score"), age)).alias("worst"))
    return picked.select(
        F.col("best.day").alias("best_day"), F.col("best.score").alias("best_score"),
        F.col("worst.day").alias("worst_day"), F.col("worst.score").alias("worst_score"))


def spark_line(health: DataFrame, value: str, days: int = TREND_DAYS, width: int = 240, height: int = 40,
               pad: int = 2) -> DataFrame:
    """(day, x, y): the series scaled into a box; a flat series has its range widened by 1."""
    everything = Window.partitionBy()
    n = F.count("*").over(everything)
    place = F.row_number().over(Window.orderBy("day")) - 1
    low, high = F.min("v").over(everything), F.max("v").over(everything)
    span = F.when(high == low, F.lit(1.0)).otherwise(high - low)
    x = F.when(n == 1, F.lit(width / 2)).otherwise(
        F.lit(pad) + place * F.lit(float(width - 2 * pad)) / F.nullif(n - 1, F.lit(0)))
    y = F.lit(pad) + F.lit(height - 2 * pad) * (1 - (F.col("v") - low) / span)
    series = last_days(health, days).select("day", F.col(value).cast("double").alias("v"))
    return series.select("day", F.round(x, 1).cast("decimal(8,1)").alias("x"), F.round(y, 1).cast("decimal(8,1)").alias("y"))


def run_statistics(runs: DataFrame, as_of: date, days: int = TREND_DAYS, job: str = DAILY_JOB) -> DataFrame:
    """Duration, count and success rate of the finished runs of the last days."""
    seconds = seconds_between(F.col("started_at"), F.col("ended_at"))
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    recent = runs.filter((F.col("job") == job) & (F.col("started_at") >= since) & F.col("ended_at").isNotNull())
    sums = recent.agg(
        F.avg(seconds).alias("a"), F.max(seconds).alias("m"), F.count("*").alias("runs_total"),
        F.count_if(F.col("status") == "OK").alias("runs_ok"))

    def two(c: Column) -> Column:
        return F.round(c, 2).cast("decimal(18,2)")

    return sums.select(
        two(F.coalesce("a", F.lit(0.0))).alias("avg_sec"), two(F.coalesce("m", F.lit(0.0))).alias("max_sec"),
        "runs_total", "runs_ok",
        two(F.try_divide(F.col("runs_ok") * F.lit(100.0), F.col("runs_total"))).alias("success_rate"))


def with_status(runs: DataFrame) -> DataFrame:
    """Final status from the counters: ERROR after a crash, PARTIAL with failures or errors, else OK."""
    return runs.withColumn("status", run_status(
        F.coalesce("crashed", F.lit(False)), F.coalesce("files_failed", F.lit(0)), F.coalesce("n_errors", F.lit(0))))


def newest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc_nulls_last("started_at"), F.desc("run_id")).limit(1)


def service_snapshot(runs: DataFrame, files: DataFrame, headers: DataFrame) -> DataFrame:
    """The newest run beside the parse backlog; one row even before the first run."""
    last = newest_run(runs).select("run_id", "job", "status", "started_at", "ended_at", F.lit(1).alias("one"))
    waiting = backlog(files, headers).withColumn("one", F.lit(1))
    return waiting.join(last, "one", "left").drop("one")
