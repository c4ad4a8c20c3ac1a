"""Brown class bigrams: exchange clustering, class transitions and word emissions.

Texts are read once, into blocks of about ``BLOCK_BYTES``: the block's vocabulary as 64-bit word hashes, and its
documents as places in that vocabulary. Words are counted over all blocks by one shuffle that carries each word once
per block, and counts go back to the blocks the same way: no vocabulary is ever held whole.

The units that are clustered are the ``FREQUENT`` most frequent words and, for all others, one unit per word ending
(``ENDINGS`` bins), so every word, known or not, has a class. Each pass counts, over all training documents, the classes
before and after each unit; the sums, a table of units by classes, reach the driver, where every second unit moves to the class that
adds most to the likelihood of the class bigrams. Nothing on the driver or in a task grows with the corpus.

P(word | previous) = P(class | class of previous) P(word | class), both with added counts (``TRANSITION``, ``EMISSION``); the latter
keeps a share for one more word in each class. A text ends with an end token, whose class also stands before its first word.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from folioflow.llm.arrays import _BYTE, Words, mix, portions
from folioflow.llm.common import crc_of, in_batches, written

FREQUENT, ENDINGS, CLASSES = 8192, 2048, 24
PASSES = 4
BLOCK_BYTES = 6 << 20
#: Tokens that are counted at once.
SLICE = 1 << 19
TRANSITION, EMISSION = 0.1, 0.5
UNITS = FREQUENT + ENDINGS + 1  # the last is the end token, alone in the last class
CHUNKS = 64


def _endings(w: Words) -> np.ndarray:
    """Bin of each word by its last three bytes."""
    key = np.zeros(len(w.start), np.uint64)
    for back in (1, 2, 3):
        at = w.end - back
        key = key * np.uint64(31) + np.where(at >= w.start, _BYTE[w.data[np.maximum(at, 0)]], np.uint64(7))
    return (mix(key) % np.uint64(ENDINGS)).astype("<u2")


_BLOCK = pa.schema([("block", pa.int64()), ("vocab", pa.binary()), ("bins", pa.binary()), ("train", pa.binary()), ("tokens", pa.binary()),
                    ("first", pa.binary()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))])


def _blocks(batches):
    def block(hashes, bins, sizes, ids, held):
        h, b = np.concatenate(hashes), np.concatenate(bins)
        vocab, at, place, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")  # frequent words get small places, which pack better
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        tokens = rank[place]
        learn = ~np.repeat(np.array(held, bool), sizes)
        train = np.bincount(tokens[learn], minlength=len(vocab))
        first = np.concatenate(([0], np.cumsum(sizes)))
        binary = lambda x, kind: [zstandard.compress(x.astype(kind).tobytes(), 1)]
        return pa.record_batch([pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array(binary(vocab[order], "<u8"), pa.binary()),
                                pa.array(binary(b[at][order], "<u2"), pa.binary()), pa.array(binary(train, "<u4"), pa.binary()), pa.array(binary(tokens, "<u4"), pa.binary()),
                                pa.array(binary(first, "<i8"), pa.binary()), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_()))], schema=_BLOCK)

    held_back, size = ([], [], [], [], []), 0
    for batch in batches:
        for first, texts in portions(batch, "text"):
            w = Words(texts)
            held_back[0].append(w.hash)
            held_back[1].append(_endings(w))
            held_back[2].extend(np.diff(w.first).tolist())
            held_back[3].extend(batch.column(0).slice(first, len(texts)).to_pylist())
            held_back[4].extend(batch.column(2).slice(first, len(texts)).to_pylist())
            size += len(w.data)
            if size >= BLOCK_BYTES:
                yield block(*held_back)
                held_back, size = ([], [], [], [], []), 0
    if held_back[0]:
        yield block(*held_back)


def _read(row: dict) -> dict[str, np.ndarray]:
    return {n: np.frombuffer(zstandard.decompress(row[n]), k) for n, k in (("vocab", "<u8"), ("bins", "<u2"), ("train", "<u4"), ("tokens", "<u4"), ("first", "<i8"))}


def _words(batches):
    for batch in batches:
        for row in batch.to_pylist():
            r = _read(row)
            for a in range(0, len(r["vocab"]), 50_000):
                s = slice(a, a + 50_000)
                n = len(r["vocab"][s])
                yield pa.record_batch([pa.array(np.full(n, row["block"])), pa.array(np.arange(a, a + n, dtype=np.int32)), pa.array(r["vocab"][s].view("<i8")),
                                       pa.array(r["bins"][s].astype(np.int32)), pa.array(r["train"][s].astype(np.int64))], names=["block", "place", "hash", "bin", "n"])


def _units(vocab: np.ndarray, bins: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """``frequent``: hashes in order of their value."""
    unit = bins + np.uint16(FREQUENT)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, vocab), len(frequent) - 1)
        known = frequent[at] == vocab
        unit[known] = at[known]
    return unit


def _sequence(r: dict, unit: np.ndarray) -> np.ndarray:
    """An end token, then the units of all documents, each with its end token."""
    return np.concatenate(([np.uint16(UNITS - 1)], np.insert(unit[r["tokens"]], r["first"][1:], UNITS - 1)))


def _contexts(classes: np.ndarray, frequent: np.ndarray):
    """Per task: how often each class stands before, and after, each unit in training documents."""
    def run(batches):
        sums = np.zeros((2, UNITS * CLASSES), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                r = _read(row)
                all_units = _sequence(r, _units(r["vocab"], r["bins"], frequent))
                learn = np.repeat(~np.array(row["held"], bool), np.diff(r["first"]) + 1)
                for at in range(0, len(learn), SLICE):
                    keep = learn[at:at + SLICE]
                    now, before = (all_units[at + j:at + j + len(keep)][keep].astype(np.int64) for j in (1, 0))
                    sums[0] += np.bincount(now * CLASSES + classes[before], minlength=sums.shape[1])
                    sums[1] += np.bincount(before * CLASSES + classes[now], minlength=sums.shape[1])
        parts = np.array_split(sums.reshape(-1), CHUNKS)
        yield pa.record_batch([pa.array(np.arange(CHUNKS, dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["chunk", "sums"])

    return run


def _add_up(batches):
    """Sums per chunk, one partial after the other."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(part, np.int64)
            sums[chunk] = sums[chunk] + part if chunk in sums else part
    if sums:
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["chunk", "sums"])


def contexts(blocks: DataFrame, classes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """(before or after, unit, class) counts over all training documents."""
    partial = in_batches(blocks.select("block", "vocab", "bins", "train", "tokens", "first", "held"), _contexts(classes, frequent), "chunk int, sums binary")
    rows = in_batches(partial.repartition("chunk"), _add_up, "chunk int, sums binary").collect()  # UNITS x CLASSES x 2 numbers
    if not rows:
        return np.zeros((2, UNITS, CLASSES), np.int64)
    found = {r["chunk"]: np.frombuffer(r["sums"], np.int64) for r in rows}
    return np.concatenate([found[c] for c in range(CHUNKS)]).reshape(2, UNITS, CLASSES)


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(classes: np.ndarray, counts: np.ndarray, turn: int) -> np.ndarray:
    """Moves every second unit, the frequent first, to the class that gains most."""
    before, after = counts.astype(float)
    pairs = np.zeros((CLASSES, CLASSES))
    np.add.at(pairs.T, classes.astype(int), before)  # pairs[previous, own]
    classes = classes.copy()
    for u in np.argsort(-before.sum(axis=1), kind="stable"):
        if u == UNITS - 1 or not before[u].any() or (turn and u % 2 != turn % 2):
            continue
        l, r, old = before[u], after[u], classes[u]
        pairs[:, old] -= l
        pairs[old, :] -= r
        np.maximum(pairs, 0, out=pairs)
        into, out = pairs.sum(axis=0), pairs.sum(axis=1)
        gain = ((_f(pairs + l[:, None]) - _f(pairs)).sum(axis=0) + (_f(pairs + r[None, :]) - _f(pairs)).sum(axis=1)
                - _f(into + l.sum()) + _f(into) - _f(out + r.sum()) + _f(out))
        gain[CLASSES - 1] = -np.inf
        new = int(np.argmax(gain))
        new = new if gain[new] > gain[old] + 1e-9 else old
        classes[u] = new
        pairs[:, new] += l
        pairs[new, :] += r
    return classes


@dataclass
class Model:
    classes: np.ndarray
    frequent: np.ndarray
    transition: np.ndarray  # log10
    class_tokens: np.ndarray
    class_words: np.ndarray
    train_tokens: int
    train_words: int


def _fit(blocks: DataFrame, counted: DataFrame) -> Model:
    lead = counted.where("hash IS NOT NULL AND c > 0")
    top = lead.select("hash", "c").orderBy(F.desc("c"), "hash").limit(FREQUENT).collect()
    by_hash = sorted((np.int64(r["hash"]).astype(np.uint64), r["c"]) for r in top)
    frequent = np.array([h for h, _ in by_hash], np.uint64)
    top_counts = np.array([c for _, c in by_hash], np.int64)
    known = F.broadcast(lead.sparkSession.createDataFrame([(r["hash"],) for r in top], "hash bigint"))  # FREQUENT rows at most
    rest = lead.join(known, "hash", "left_anti").groupBy("bin").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()  # ENDINGS rows
    tokens, kinds = np.zeros(UNITS, np.int64), np.zeros(UNITS, np.int64)
    tokens[:len(frequent)], kinds[:len(frequent)] = top_counts, 1
    for r in rest:
        tokens[FREQUENT + r["bin"]], kinds[FREQUENT + r["bin"]] = r["n"], r["v"]

    classes = np.full(UNITS, CLASSES - 2, np.int8)
    first = np.argsort(-tokens[:FREQUENT], kind="stable")[:CLASSES - 2]
    classes[first] = np.arange(len(first))
    classes[UNITS - 1] = CLASSES - 1
    for turn in range(PASSES):
        classes = exchange(classes, contexts(blocks, classes, frequent), turn)
    pairs = np.zeros((CLASSES, CLASSES))
    np.add.at(pairs.T, classes.astype(int), contexts(blocks, classes, frequent)[0].astype(float))
    ends = pairs[:, CLASSES - 1].sum()
    transition = np.log10((pairs + TRANSITION) / (pairs.sum(axis=1, keepdims=True) + TRANSITION * CLASSES))
    class_tokens, class_words = np.bincount(classes, tokens, CLASSES), np.bincount(classes, kinds, CLASSES)
    return Model(classes, frequent, transition, class_tokens, class_words, int(tokens.sum() + ends), int(kinds.sum() + (ends > 0)))


_SCORE = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _score(m: Model, ends: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in _SCORE.split(", ")]
        out = []
        for row in left.to_pylist():
            r = _read(row)
            c = np.zeros(len(r["vocab"]), np.int64)
            c[right["place"].to_numpy()] = right["c"].to_numpy()
            unit = _units(r["vocab"], r["bins"], m.frequent)
            own = m.classes[unit]
            emit = np.log10((c + EMISSION) / (m.class_tokens[own] + EMISSION * (m.class_words[own] + 1)))
            base = np.log10((c + 1) / (m.train_tokens + m.train_words + 1))
            chain = m.classes[_sequence(r, unit)]
            n = np.diff(r["first"])
            doc = np.repeat(np.arange(len(n)), n + 1)
            token_doc = np.repeat(np.arange(len(n)), n)
            add = lambda v, d: np.bincount(d, v, minlength=len(n))
            end_base = np.log10((ends + 1) / (m.train_tokens + m.train_words + 1))
            score = add(emit[r["tokens"]], token_doc) + add(m.transition[chain[:-1], chain[1:]], doc)
            known = add((c > 0)[r["tokens"]].astype(float), token_doc).astype(np.int64) + (ends > 0)
            out.append(pa.table([pa.array(row["ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(n + 1), pa.array(known),
                                 pa.array(np.full(len(n), m.train_tokens)), pa.array(add(base[r["tokens"]], token_doc) + end_base), pa.array(score)], names=names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], names=names)

    return run


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row, repeated rows included.

    Learns from rows whose crc32(doc_id) mod 7 is not 2; without any, every word is unknown. Null counts as the empty text: one
    end token. A null doc_id stays null and counts as the empty text in the crc. Scores are log10 probabilities.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), (crc_of(doc_id) % 7 == 2).alias("held"))
    blocks = written(in_batches(rows, _blocks, "block bigint, vocab binary, bins binary, train binary, tokens binary, first binary, ids array<bigint>, held array<boolean>"), "blocks")
    per_word = in_batches(blocks.select("block", "vocab", "bins", "train", "tokens", "first"), _words, "block bigint, place int, hash bigint, bin int, n bigint")
    same = Window.partitionBy("hash")
    counted = written(per_word.withColumn("c", F.sum("n").over(same)).withColumn("lead", F.min("block").over(same) == F.col("block"))
                      .select("block", "place", "c", F.when(F.col("lead"), F.col("hash")).alias("hash"), F.when(F.col("lead"), F.col("bin")).alias("bin")), "counts")
    model = _fit(blocks, counted)
    ends = blocks.select(F.sum(F.size(F.filter("held", lambda h: ~h))).alias("n")).first()["n"] or 0
    return blocks.groupBy("block").cogroup(counted.select("block", "place", "c").groupBy("block")).applyInArrow(_score(model, int(ends)), _SCORE)
