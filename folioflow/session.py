"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A hot document key is split by AQE even where the split costs one more exchange, and a join on
# (document, line) may use rows that are partitioned by document.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "folioflow") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        # Plans are built faster when Python call sites are not recorded.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local master, as in tests,
    may fall back to a temporary folder of the machine.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="folioflow-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, folder: str) -> None:
    """Removes a folder that ``work_folder`` named, once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go once it is done, not when the driver happens to collect its garbage.

    For a row of jobs whose results are written, as of a load: a plan that is run again makes its files again.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


#: Most rows that are sent to every task: some columns of keys or names.
FEW_ROWS = 100_000


def bounded(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows that a join looks up: broadcast if they are few, else hashed by shuffle, so that the other side is not sorted."""
    return F.broadcast(rows) if n <= FEW_ROWS else rows.hint("shuffle_hash")


SPLIT_BYTES = 16 * 1024 * 1024


def spread(rows: DataFrame) -> DataFrame:
    """Deals out the rows of an input too small to occupy all cores by its own splits.

    For costly per-row work such as parsing. The size is the planner's estimate of the scan, so
    this decides without a job; an input of ``SPLIT_BYTES`` per core or more stays where it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return rows.repartition(cores) if size < cores * SPLIT_BYTES else rows
