"""HTML and plain text documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.scalars import squeeze
from folioflow.functions.text_fields import header_fields, visible_text

HTML_NAME = r"(?i)\.html?$"


def lossy_text(octets: Column) -> Column:
    """Bytes as UTF-8; bytes that do not fit are left out."""
    return F.replace(F.make_valid_utf8(octets.cast("string")), F.lit("\N{REPLACEMENT CHARACTER}"), F.lit(""))


TEXT_NAMES = "*.{[hH][tT][mM],[hH][tT][mM][lL],[tT][xX][tT]}"


def listed_texts(spark: SparkSession, path: str | list[str], modified_after: str | None = None) -> DataFrame:
    """(file, path) of printed documents; contents are not read."""
    reader = spark.read.option("pathGlobFilter", TEXT_NAMES).option("recursiveFileLookup", "true")
    reader = reader.option("modifiedAfter", modified_after) if modified_after else reader
    return reader.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), "path")


def text_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, text) of all files below ``path``, HTML by its visible text."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    text = lossy_text(F.col("value").cast("binary"))
    name = F.col("_metadata.file_path")
    return raw.select(name.alias("file"), plain_text(name, text).alias("text"))


def plain_text(name: Column, text: Column) -> Column:
    return F.when(name.rlike(HTML_NAME), visible_text(text)).otherwise(squeeze(text))


def headers_from_text(documents: DataFrame, text: str = "text") -> DataFrame:
    """Header fields of each document; there are no lines to read in free text."""
    kept = [c for c in documents.columns if c != text]
    return documents.select(*kept, *header_fields(F.col(text)))
