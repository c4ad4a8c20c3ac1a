"""Enrichment of stored lines, load by load."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from folioflow.functions.taxonomy import FITTINGS, Taxonomy
from folioflow.operators.enrichment import ENRICHED, classify
from folioflow.sources.store import Store


def pending_lines(store: Store, version: str) -> DataFrame:
    """Lines of the loads that this taxonomy version has not judged yet."""
    judged = store.enriched(version).select("load_id").distinct()
    return store.read("lines").join(judged, "load_id", "left_anti")


def enrich_store(store: Store, taxonomy: Taxonomy = FITTINGS, force: bool = False) -> int:
    """Judges pending lines, or with ``force`` all, and returns how many.

    Each line is judged where it is read; the result is then rebalanced by load, so that a load gets few files.
    """
    lines = store.read("lines") if force else pending_lines(store, taxonomy.version)
    if lines.isEmpty():
        return 0
    seen = Observation()
    store.write_enriched(classify(lines, taxonomy).observe(seen, F.count("*").alias("n")))
    return seen.get["n"]


def lines_with_enrichment(store: Store, version: str = FITTINGS.version) -> DataFrame:
    """All lines, with NULL enrichment where this version has not judged them yet."""
    done = store.enriched(version)
    pending = pending_lines(store, version)
    blank = [F.lit(None).cast(done.schema[c].dataType).alias(c) for c in ENRICHED]
    return done.unionByName(pending.select("*", *blank))
