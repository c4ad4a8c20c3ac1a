"""Benchmark decontamination by winnowing.

A benchmark item is cut into windows of ``span`` words (a shorter item is one window). Of the k-gram
hashes inside a window the smallest is its fingerprint. A document is winnowed the same way: sliding over its
k-gram hashes, each run of windows with one and the same minimum leaves one row (fingerprint, first window, last
window). A window of the document that equals one of an item has the same k-grams, hence the same minimum: joining
fingerprints therefore misses no shared span of ``span`` words. A joined run is extended: each of its
windows is compared, word by word, with the item windows.

The documents' texts are shuffled once, for the documents with joined runs. Fingerprints of the benchmark are
broadcast only after they were counted; larger benchmarks join by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import ALNUM, ascii_lower, indices, let, small, words, written

SPAN = 13
KGRAM = 5


def tokens(text: Column) -> Column:
    return words(ascii_lower(F.coalesce(text, F.lit(""))), ALNUM)


def _minima(w: Column, span: int, kgram: int) -> Column:
    """The winnowed minimum of each window of ``span`` words, by window start."""
    k = min(kgram, span)
    grams = F.transform(indices(F.size(w) - k + 1), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
    if span == k:
        return grams
    return let(grams, lambda g: F.transform(
        indices(F.size(g) - (span - k)), lambda i: F.least(*[F.get(g, i + j) for j in range(span - k + 1)])))


def _runs(w: Column, span: int, kgram: int) -> Column:
    """Winnowed fingerprints: (fp, span, first, last) for each run of windows with the same minimum."""
    def of(m: Column) -> Column:
        starts = F.filter(indices(F.size(m)), lambda i: (i == 0) | (F.get(m, i) != F.get(m, i - 1)))
        return let(starts, lambda s: F.transform(s, lambda a, j: F.struct(
            F.get(m, a).alias("fp"), F.lit(span).alias("span"), a.alias("first"),
            (F.coalesce(F.get(s, j + 1), F.size(m)) - 1).alias("last"))))

    return let(_minima(w, span, kgram), of)


def _windows(w: Column, span: Column, starts: Column) -> Column:
    return F.transform(starts, lambda i: F.struct(
        span.alias("span"), i.alias("at"), F.array_join(F.slice(w, i + 1, span), " ").alias("window")))


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", span: int = SPAN, kgram: int = KGRAM) -> DataFrame:
    """(item_id string, span, window, fp) of every window of every item; a null id counts as the empty string."""
    cut = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"),
        F.inline(F.transform(F.array(tokens(F.col(text))), lambda w: F.struct(
            w.alias("w"), F.least(F.size(w), F.lit(span)).alias("span"))))).where("span > 0")
    flat = cut.select("item_id", F.inline(_windows(F.col("w"), F.col("span"), indices(F.size("w") - F.col("span") + 1))))
    w = F.split("window", " ")
    by_span = F.lit(None).cast("bigint")
    for n in range(1, span + 1):
        by_span = F.when(F.col("span") == n, F.get(_minima(w, n, kgram), F.lit(0))).otherwise(by_span)
    return flat.select("item_id", "span", "window").distinct().withColumn("fp", by_span)


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 span: int = SPAN, kgram: int = KGRAM, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, key, n_words, n_hit, n_items, items): one row per row of ``docs``, repeated rows included.

    ``n_hit`` counts the words inside any window shared with an item, ``items`` lists the ids of the items
    with such windows, as strings in order. Null and empty texts have no words, empty tables no rows or
    no hits. A null document id is kept as it is. ``key`` names the row for joins.
    """
    windows = written(item_windows(benchmark, item_id, item_text, span, kgram), "item-windows")
    spans = sorted(r[0] for r in windows.select("span").distinct().collect())  # at most ``span`` numbers
    prints = small(written(windows.select("fp", "span").distinct(), "item-prints"))
    row = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("key"),
                      F.col(text).alias("text"))

    def found(w: Column) -> Column:
        head = F.struct(F.col("key").alias("fp"), F.lit(0).alias("span"), F.size(w).alias("first"), F.lit(0).alias("last"))
        return F.concat(F.array(head), *[_runs(w, n, kgram) for n in spans])

    # One head row per document, with its number of words, and one row per fingerprint.
    printed = row.select("doc_id", "key", F.inline(let(tokens(F.col("text")), found)))
    joined = printed.join(prints.withColumn("hit", F.lit(True)), ["fp", "span"], "left").where("span = 0 OR hit")
    joined = written(joined.select("doc_id", "key", "span", "first", "last"), "doc-prints")
    heads = joined.where("span = 0").select("doc_id", "key", F.col("first").cast("long").alias("n_words"))
    runs = joined.where("span > 0").groupBy("key").agg(F.collect_set(F.struct("span", "first", "last")).alias("runs"))

    def extend(w: Column) -> Column:
        return F.flatten(F.transform(F.col("runs"), lambda r: _windows(w, r["span"], F.sequence(r["first"], r["last"]))))

    texts = row.select("key", "text").join(runs, "key").select("key", F.inline(let(tokens(F.col("text")), extend)))
    numbered = small(written(windows.select("span", "window").distinct().withColumn(
        "window_id", F.xxhash64("window", "span")), "window-ids"))
    hits = written(texts.join(numbered, ["span", "window"]).select("key", "span", "at", "window_id").distinct(), "hits")

    # Union of the hit windows: words from the furthest end so far.
    spot = F.array_sort(F.collect_list(F.struct("at", (F.col("at") + F.col("span")).alias("end"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    union = F.aggregate(spot, start, lambda a, x: F.struct(
        (a["n"] + F.greatest(x["end"] - F.greatest(x["at"], a["end"]), F.lit(0)).cast("long")).alias("n"),
        F.greatest(a["end"], x["end"]).alias("end")))
    n_hit = hits.groupBy("key").agg(union["n"].alias("n_hit"))
    owners = windows.select(F.xxhash64("window", "span").alias("window_id"), "item_id").distinct()
    items = (hits.select("key", "window_id").distinct().join(owners, "window_id").groupBy("key")
             .agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    none = F.array().cast("array<string>")
    return (heads.join(n_hit.join(items, "key", "left"), "key", "left")
            .select("doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(F.coalesce("items", none)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items")))


def is_contaminated() -> Column:
    """The rule: at least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they were."""
    dirty = contaminated(docs, benchmark).where(is_contaminated()).select("key").distinct()
    mark = F.xxhash64(docs["doc_id"], docs["text"])
    return docs.join(dirty, mark == dirty["key"], "left_anti")
