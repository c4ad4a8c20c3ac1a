"""Incremental ingest: files that arrive are loaded once, in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioflow.plans.ingest import Run, load_documents, load_texts
from folioflow.sources.store import Store
from folioflow.sources.text_documents import TEXT_NAMES, text_files
from folioflow.sources.xml_documents import WHOLE_FILE_BYTES, XML_NAMES, literal_path, scan_documents, unseen

#: Files per micro-batch; also the most names the driver holds at a time.
FILES_PER_BATCH = 10_000


def arriving_files(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH, names: str = XML_NAMES) -> DataFrame:
    """A stream of file names; contents are read by the batch that loads them."""
    return (
        spark.readStream.format("binaryFile").option("pathGlobFilter", names)
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
        .schema("path string, modificationTime timestamp, length bigint, content binary").load(path).select(
            F.col("_metadata.file_path").alias("file"), "path")
    )


def stream_ingest(store: Store, path: str, checkpoint: str, *, name: str = "arrivals", job: str = "etl_daily",
                  files_per_batch: int = FILES_PER_BATCH, whole_file_bytes: int = WHOLE_FILE_BYTES,
                  available_now: bool = True, texts: bool = False, **load) -> StreamingQuery:
    """Loads new files and stops, or keeps running with ``available_now=False``. ``texts``: printed documents, HTML or text, not XML.

    The load id comes from the query id that the checkpoint keeps and the micro-batch number: a batch that is
    repeated after a failure replaces its own rows, and no other stream's. Files that another load has
    registered are left out. Each batch loads, checks and logs like a batch job.
    """
    spark = store.spark

    def load_batch(batch: DataFrame, number: int) -> None:
        stream_id = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
        run_id = f"{name}-{stream_id}-{number}"
        arrived = batch.select("file", "path")
        # Bounded by files_per_batch.
        paths = [literal_path(r.path) for r in unseen(arrived, store.read("files", but=run_id)).collect()]
        if not paths:
            return
        part = Run(job=job, source="stream", run_id=run_id)
        if texts:
            load_texts(store, text_files(spark, paths), part, **load)
        else:
            load_documents(store, scan_documents(spark, paths, whole_file_bytes=whole_file_bytes), part, **load)

    writer = arriving_files(spark, path, files_per_batch, TEXT_NAMES if texts else XML_NAMES).writeStream.foreachBatch(load_batch).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
