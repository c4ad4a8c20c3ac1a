"""Phrase collocations from a weighted de Bruijn graph of word four-grams.

1. Texts are cut into pieces and words. Words, and pairs of neighbours, are counted by hash into 2^``BITS`` buckets. One in a bucket of fewer than ``LEAST``
   occurrences is in no candidate, nor in part of one: pieces end at such a word, and between the words of such a pair. What this leaves out changes no count that
   matters: all occurrences of a frequent phrase stay whole. Three words that are left are counted the same way, and where they are rare, the piece is cut in two that
   share the middle word, which is then taken off its count once. A task's counts stop at ``LEAST``, which decides the sum of all tasks as well, so buckets have the same
   size however large the corpus.
2. A four-gram is an edge from the node of its first three words to the next word; its weight is how often it stands in the corpus. Tasks
   sum up the edges of some megabytes of text, Spark adds these sums: only the longest grams are counted, and per piece its end, the last three words
   (or the piece, if it is shorter). A node occurs as often as its outgoing edges do, plus the pieces that end with it: sums over the rows of a node, which
   one shuffle has brought together. Counts of two words are sums of these by their first two plus ends, and of one word alike: the ends of
   two and one words follow from those of three. Only what has ``LEAST`` occurrences is kept of longer grams.
3. Unary paths are compacted: where all that leaves one node enters the next, and nothing else does, the edge joins both. Path heads
   are found by pointer doubling, one join per round. All nodes of a path have its count, so each lies in a longer phrase
   that occurs as often; they are left out without looking further. ``Graph.paths`` gives the paths themselves.
4. The other phrases are compared with the phrases one word longer that hold them, which suffices: what holds a phrase with two words more
   occurs at most as often as the one between. Cuts are scored by two joins with the counts of their parts.

All keys are the words themselves, not hashes. A hot edge reaches the shuffle as one row per portion, a hot phrase of two words or one
as one per task, and the limit per language is taken in each task before it. Tables between steps are Parquet in the shared folder.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.arrays import mix, portions
from folioflow.llm.common import in_batches, written

#: Words of the longest grams.
WORDS = 4
LEAST, SHARE, TOP = 30, 80, 2000
#: Bytes of text whose edges are summed up in a task at once.
PORTION = 8 << 20
#: Buckets of hashes of words and pairs, of which tasks are sent one bit each: 4 MB; they are summed up in chunks.
BITS, CHUNK = 25, 1 << 13
#: Words whose buckets are counted at once.
SLICE = 1 << 18
UNKNOWN = "und"

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BREAK, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK[list(b" \t")] = True


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each value, the distinct values)."""
    coded = pa.array(values).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy()


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = pc.value_counts(pa.array(values, pa.int64()))
    return found.field("values").to_numpy(), found.field("counts").to_numpy()


class _Portion:
    """Words of some texts, by number, in pieces: ``one`` per word, its spelling and language in ``word_of``."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        data = np.frombuffer(b"\n".join(texts).translate(_LOWER) + b"\n", np.uint8)
        ends = _BREAK[data]
        apart = ends | _BLANK[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], apart)).view(np.int8)))
        start, end = edge[::2], edge[1::2]
        self.piece = np.cumsum(ends)[start]
        doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, "right")
        upto = np.concatenate(([0], np.cumsum(end - start)))
        words = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(data[~apart])]).dictionary_encode()
        self.spelled, self.names = words.dictionary.cast(pa.string()), pa.array(langs, pa.string()).dictionary_encode()
        kinds = max(1, len(self.spelled))
        self.one, self.word_of = _numbered(self.names.indices.to_numpy().astype(np.int64)[doc] * kinds + words.indices.to_numpy())
        self.place, self.lang = self.word_of % kinds, self.word_of // kinds
        self.again = self.one[:0]

    @cached_property
    def hashes(self) -> np.ndarray:
        """Hash of each word in ``word_of``."""
        names = [n.encode() for n in self.names.dictionary.to_pylist()]
        spelled = [w.encode() for w in self.spelled.to_pylist()]
        return np.array([xxhash.xxh3_64_intdigest(spelled[w], len(names[x])) ^ xxhash.xxh3_64_intdigest(names[x]) for w, x in zip(self.place, self.lang)], np.uint64)

    def grams(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where so many words of one piece begin, and their buckets."""
        at = np.flatnonzero(self.piece[words - 1:] == self.piece[:len(self.piece) - words + 1])
        made = self.hashes[self.one[at]]
        for k in range(1, words):
            made = mix(made * np.uint64(0x9E3779B97F4A7C15)) + self.hashes[self.one[at + k]]
        return at, (mix(made) >> np.uint64(64 - BITS)).astype(np.int64)

    def rare(self, words: int, common: np.ndarray) -> np.ndarray:
        """Places where so many words begin whose bucket is rare; ``common`` has a bit per bucket."""
        at, bucket = self.grams(words)
        return at[(common[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8) & 1) == 0]

    def cut(self, common: np.ndarray) -> None:
        """Leaves out the occurrences of rare words; there, and between the words of rare pairs, pieces then end."""
        gone, begins = np.zeros(len(self.one), bool), np.zeros(len(self.one), bool)
        gone[self.rare(1, common)] = True
        begins[self.rare(2, common) + 1] = True
        self.piece = (self.piece + np.cumsum(gone) + np.cumsum(begins))[~gone]
        self.one = self.one[~gone]

    def part(self, common: np.ndarray) -> None:
        """Cuts pieces at rare groups of three words: the middle one, listed in ``again``, ends one piece and begins the next."""
        middle = self.rare(3, common) + 1
        self.again = self.one[middle]
        times = np.ones(len(self.one), np.int64)
        times[middle] = 2
        copy = np.zeros(times.sum(), bool)
        copy[middle + np.arange(1, len(middle) + 1)] = True
        self.piece = np.repeat(self.piece, times) + np.cumsum(copy)
        self.one = np.repeat(self.one, times)

    def told(self, count: np.ndarray, *of: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """(key, count): the words, one array of numbers for each place, and after a tab, which no word has, the language. Rows are in order of
        the first words, so that neighbours compress well."""
        order = np.lexsort((of[1], of[0])) if len(of) > 1 else np.argsort(of[0])
        of = [x[order] for x in of]
        words = [self.spelled.take(pa.array(self.place[x])) for x in of]
        gram = pc.binary_join_element_wise(*words, " ") if len(of) > 1 else words[0]
        return pc.binary_join_element_wise(gram, self.names.dictionary.take(pa.array(self.lang[of[0]])), "\t"), count[order]


def edges(p: _Portion) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(key, count) of edges, four words; and of ends of pieces, up to three words, whose counts are negative; words in two pieces are taken off
    the ends of one word."""
    if not len(p.one):
        return
    near = np.flatnonzero(p.piece[1:] == p.piece[:-1])
    two = np.full(len(p.one), -1, np.int64)
    two[near], pair_of = _numbered(p.one[near] * len(p.word_of) + p.one[near + 1])
    last = np.flatnonzero(np.append(p.piece[1:] != p.piece[:-1], True))
    length, pairs = np.diff(last, prepend=-1), max(1, len(pair_of))
    halves = lambda pair: (pair_of[pair] // len(p.word_of), pair_of[pair] % len(p.word_of))
    whole = np.flatnonzero(p.piece[3:] == p.piece[:-3])
    gram, n = _counted(two[whole] * pairs + two[whole + 2])
    yield p.told(n, *halves(gram // pairs), *halves(gram % pairs))
    at = last[length >= 3]
    gram, n = _counted(two[at - 2] * len(p.word_of) + p.one[at])
    yield p.told(-n, *halves(gram // len(p.word_of)), gram % len(p.word_of))
    gram, n = _counted(two[last[length == 2] - 1])
    yield p.told(-n, *halves(gram))
    off = np.bincount(p.again, minlength=len(p.word_of)) - np.bincount(p.one[last[length == 1]], minlength=len(p.word_of))
    gram = np.flatnonzero(off)
    yield p.told(off[gram], gram)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[_Portion]:
    texts, langs, size = [], [], 0
    for batch in batches:
        spoken = batch.column(0).to_pylist()
        for first, held in portions(batch, "text", PORTION):
            texts += held
            langs += spoken[first:first + len(held)]
            size += sum(map(len, held))
            if size >= PORTION:
                yield _Portion(texts, langs)
                texts, langs, size = [], [], 0
    if texts:
        yield _Portion(texts, langs)


def _common(bits: dict[int, bytes]) -> np.ndarray:
    common = np.zeros((1 << BITS) // 8, np.uint8)
    for chunk, held in bits.items():
        common[chunk * CHUNK // 8:(chunk + 1) * CHUNK // 8] = np.frombuffer(zstandard.decompress(held), np.uint8)
    return common


def _buckets(least: int, bits: dict[int, bytes] | None = None):
    """(lang, n) of all words of a task; and (chunk, held): its counts of a chunk of buckets, none above ``least``, as compressed numbers. Counted are
    words and pairs, or with their ``bits`` groups of three words without rare ones among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, total, held = ["lang", "n", "chunk", "held"], Counter(), np.zeros(1 << BITS, np.min_scalar_type(least))
        common = None if bits is None else _common(bits)
        for p in _portions(batches):
            for lang, n in zip(p.names.dictionary.to_pylist(), np.bincount(p.lang[p.one], minlength=len(p.names.dictionary))):
                total[lang] += int(n)
            if common is None:
                found = [p.grams(1)[1], p.grams(2)[1]]
            else:
                p.cut(common)
                found = [p.grams(3)[1]]
            for some in found:
                for i in range(0, len(some), SLICE):
                    at, more = _counted(some[i:i + SLICE])
                    held[at] = np.minimum(held[at] + more, least)
        yield pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64()), pa.nulls(len(total), pa.int32()), pa.nulls(len(total), pa.binary())], names=names)
        for chunk, counts in enumerate(held.reshape(-1, CHUNK)):
            if counts.any():
                yield pa.record_batch([pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([chunk], pa.int32()), pa.array([zstandard.compress(counts.tobytes())], pa.binary())], names=names)

    return run


def _bits(least: int):
    """Counts of the same chunk added; of each chunk one compressed bit per bucket: whether it has ``least`` occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(zstandard.decompress(held), np.min_scalar_type(least))
                total[chunk] = np.minimum(total[chunk] + counts.astype(np.int64), least).astype(counts.dtype) if chunk in total else counts
        for chunk, counts in total.items():
            yield pa.record_batch([pa.array([chunk], pa.int32()), pa.array([zstandard.compress(np.packbits(counts >= least).tobytes())], pa.binary())], names=["chunk", "bits"])

    return run


def _edges(pairs: dict[int, bytes], threes: dict[int, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two, three = _common(pairs), _common(threes)
        for p in _portions(batches):
            p.cut(two)
            p.part(three)
            for key, n in edges(p):
                for i in range(0, len(n), 20_000):
                    yield pa.record_batch([key[i:i + 20_000], pa.array(n[i:i + 20_000])], names=["key", "f"])

    return run


def _first(gram: str | Column, words: int) -> Column:
    return F.substring_index(gram, " ", words)


def _last(gram: str | Column, words: int) -> Column:
    return F.substring_index(gram, " ", -words)


def _key(words: str, key: str = "key") -> str:
    """SQL of the first (or, negative, last) words of a key, with its language."""
    return f"concat(substring_index(substring_index({key}, '\t', 1), ' ', {words}), substr({key}, instr({key}, '\t')))"


#: Words of a key.
_WORDS = "(length(substring_index(key, '\t', 1)) - length(replace(substring_index(key, '\t', 1), ' ', '')) + 1)"


class Graph:
    """Phrases of up to four words that occur ``least`` times or more, by language.

    Null texts and texts without words add nothing; a null language counts as ``und``. Repeated rows count each. An empty table gives empty
    results. Other columns of ``docs`` are not read. Words: runs of all but space and tab, A-Z lower-cased, in pieces between any of
    ``.,;:!?`` and line ends.
    """

    def __init__(self, docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST):
        self.docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
        self.least = least

    def _counted(self, purpose: str, bits: dict[int, bytes] | None = None) -> DataFrame:
        """(lang, n) and (chunk, held) of every task."""
        return written(in_batches(self.docs.where("text IS NOT NULL"), _buckets(self.least, bits), "lang string, n bigint, chunk int, held binary"), purpose)

    @cached_property
    def _pairs(self) -> DataFrame:
        return self._counted("pair_buckets")

    def totals(self) -> DataFrame:
        """(lang, n): all word occurrences."""
        return self._pairs.where("chunk IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))

    def _common(self, counts: DataFrame) -> dict[int, bytes]:
        """Bits of the buckets that may hold frequent words or phrases; 2^BITS bits at most, on the driver too."""
        chunks = counts.where("chunk IS NOT NULL").select("chunk", "held").repartition("chunk")
        return {r["chunk"]: r["bits"] for r in in_batches(chunks, _bits(self.least), "chunk int, bits binary").collect()}

    @cached_property
    def phrases(self) -> DataFrame:
        """(lang, gram, kind, f): frequent words and phrases of up to four words (kind: their number)."""
        pairs = self._common(self._pairs)
        made = in_batches(self.docs.where("text IS NOT NULL"), _edges(pairs, self._common(self._counted("three_buckets", pairs))), "key string, f bigint")
        # Already summed up in portions, so shuffled as it is, once, by the first three words: both aggregates read the same exchange.
        made = made.repartition(F.expr(_key("3")))
        row = "named_struct('key', {}, 'f', {}, 'ended', {})".format
        none = "cast(array() as array<struct<key:string,f:bigint,ended:bigint>>)"
        nodes = made.groupBy(F.expr(_key("3")).alias("key")).agg(F.sum(F.abs("f")).alias("f"), F.sum(F.when(F.col("f") < 0, -F.col("f")).otherwise(0)).alias("ended"), F.sum(-F.col("f")).alias("alone")).withColumn("words", F.expr(_WORDS))
        # What leaves a node begins with its first two words, and a piece that ends with it ends with its last two.
        told = f"""CASE WHEN words < 3 THEN array({row("key", "0L", "alone")}) ELSE concat(array({row(_key("2"), "f", "0L")}),
            CASE WHEN ended > 0 THEN array({row(_key("-2"), "0L", "ended")}) ELSE {none} END, CASE WHEN f >= {self.least} THEN array({row("key", "f", "0L")}) ELSE {none} END) END"""
        pairs = nodes.select(F.expr(f"inline({told})")).groupBy("key").agg(F.sum("f").alias("f"), F.sum("ended").alias("ended")).withColumn("words", F.expr(_WORDS))
        # The same for pairs, which occur as often as nodes and ends tell together.
        told = f"""CASE WHEN words = 2 THEN concat(array({row(_key("1"), "f + ended", "0L")}), CASE WHEN ended > 0 THEN array({row(_key("-1"), "ended", "0L")}) ELSE {none} END,
            CASE WHEN f + ended >= {self.least} THEN array({row("key", "f + ended", "0L")}) ELSE {none} END) ELSE array({row("key", "f + ended", "0L")}) END"""
        shorter = pairs.select(F.expr(f"inline({told})")).groupBy("key").agg(F.sum("f").alias("f"))
        # Grouped by the node too: no further shuffle. The words are an aggregate, as a filter of the key would go below the exchange and part it from the one above.
        edge = made.groupBy(F.expr(_key("3")).alias("node"), "key").agg(F.sum("f").alias("f"), F.max(F.expr(_WORDS)).alias("words"))
        found = shorter.union(edge.where(F.col("words") == WORDS).select("key", "f")).where(F.col("f") >= self.least)
        return written(found.select(F.expr("substr(key, instr(key, '\t') + 1)").alias("lang"), F.expr("substring_index(key, '\t', 1)").alias("gram"), F.expr(_WORDS).alias("kind"), "f"), "phrases")

    def frequent(self, words: int) -> DataFrame:
        return self.phrases.where(F.col("kind") == words).select("lang", "gram", "f")

    @cached_property
    def _steps(self) -> DataFrame:
        """(lang, node, head, steps) of every node that a unary edge enters: its path's head, and how many edges lie between."""
        nodes = self.frequent(WORDS - 1)
        ends = self.frequent(WORDS).select("lang", "f", _first("gram", WORDS - 1).alias("head"), _last("gram", WORDS - 1).alias("node"))
        of = lambda name: nodes.select("lang", "f", F.col("gram").alias(name))
        # The count of both nodes is the edge's: all of the first leaves by it, all of the second comes by it.
        now = written(ends.join(of("head"), ["lang", "f", "head"]).join(of("node"), ["lang", "f", "node"]).select("lang", "node", "head", F.lit(1).cast("bigint").alias("steps")), "path_steps")
        while True:
            further = now.select("lang", F.col("node").alias("head"), F.col("head").alias("to"), F.col("steps").alias("more"))
            made = written(now.join(further, ["lang", "head"], "left").select("lang", "node", F.coalesce("to", "head").alias("head"),
                                                                               (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("to").isNotNull().alias("moved")), "path_steps")
            now = made.drop("moved")
            if made.where("moved").isEmpty():  # a cycle would need a piece without a beginning
                return now

    def paths(self) -> DataFrame:
        """(lang, path, f): every unary path of at least one edge, as the text of all its words, no longer than a piece of one text."""
        told = self._steps.groupBy("lang", "head").agg(F.array_sort(F.collect_list(F.struct("steps", _last("node", 1).alias("word")))).alias("words"))
        told = told.select("lang", F.col("head").alias("gram"), F.array_join(F.col("words.word"), " ").alias("rest"))
        return told.join(self.frequent(WORDS - 1), ["lang", "gram"]).select("lang", F.concat_ws(" ", "gram", "rest").alias("path"), "f")

    def candidates(self, share: int = SHARE) -> DataFrame:
        """(lang, phrase, words, a): frequent phrases of 2 to 4 words that no longer one holds in ``share`` percent of their occurrences."""
        steps = self._steps
        inside = steps.select("lang", F.col("node").alias("gram")).union(steps.select("lang", F.col("head").alias("gram"))).distinct()
        branching = self.frequent(WORDS - 1).join(inside, ["lang", "gram"], "left_anti")
        out = self.frequent(WORDS).withColumn("words", F.lit(WORDS))
        for words, some in ((WORDS - 1, branching), (2, self.frequent(2))):
            longer = self.frequent(words + 1)
            held = longer.select("lang", _first("gram", words).alias("gram"), "f").union(longer.select("lang", _last("gram", words).alias("gram"), "f")).groupBy("lang", "gram").agg(F.max("f").alias("most"))
            exact = lambda c: F.col(c).cast("decimal(20,0)")
            free = some.join(held, ["lang", "gram"], "left").where(F.col("most").isNull() | (F.lit(100) * exact("most") < F.lit(share) * exact("f")))
            out = out.union(free.select("lang", "gram", "f", F.lit(words).alias("words")))
        return out.select("lang", F.col("gram").alias("phrase"), "words", F.col("f").alias("a"))

    def scored(self, share: int = SHARE) -> DataFrame:
        """(lang, phrase, a, l, r, n, score): the candidates at their lowest-scoring cut, ties to the shortest first part."""
        cuts = self.candidates(share).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substring_index(phrase, ' ', k - words)"))
        known = self.phrases
        cuts = cuts.join(known.select("lang", F.col("gram").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(known.select("lang", F.col("gram").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        cuts = cuts.withColumn("score", F.expr("(2000000BD * cast(a AS decimal(20,0))) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))"))
        best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        return best.join(self.totals(), "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    def top(self, limit: int = TOP, share: int = SHARE) -> DataFrame:
        """(lang, rank, phrase, a, l, r, n, score): the first ``limit`` of each language by score, count, then phrase in byte order."""
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = self.scored(share).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
        return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
