"""A training corpus from raw documents, in five stages, each one operator of ``folioflow.llm``.

Every stage takes all rows that its predecessor kept. All but the last return the columns of
``documents``; the last returns the encoded corpus. Between stages the rows are a Parquet table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import byte_pairs, decontaminate, near_duplicates, pseudonyms, quality_rules
from folioflow.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule; texts that are null, empty or short go."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near-duplicates."""
    return near_duplicates.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stands in the benchmark too."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced under the key in CORPUS_PII_KEY."""
    return pseudonyms.pseudonymise_column(docs, os.environ.get("CORPUS_PII_KEY", "check-key"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, token ids as little-endian unsigned 32-bit integers, digests of ids and decoded text."""
    return byte_pairs.encode(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("byte_pairs", encoding)]

#: SQL has neither MinHash bands, Feistel networks nor byte pairs: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
