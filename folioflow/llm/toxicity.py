"""Toxicity by a convolutional text classifier, trained here in numpy.

Each word has the sum of two rows of hashed embedding tables, so words that share one row still differ. Filters
over one, two and three neighbouring words, a rectifier and the maximum over the whole text give the
features of a logistic output. The model learns from every labelled row: the rows are dealt into shards of about
``SHARD_ROWS``, each shard is fitted by Adagrad in a task of its own from the model of the round before, and Spark averages
what the shards changed. A third of the labelled rows, all of them counted, is kept for a logistic calibration of the score and for each
language's threshold with the best F1. Language never enters a score.
Scoring is one pass over all texts, as a whole, with memory bounded by portions of a batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.arrays import Words, portions
from folioflow.llm.common import crc_of, in_batches

#: Labelled rows of a shard, about; words that a task holds at a time.
SHARD_ROWS, BLOCK_WORDS = 12_000, 1 << 22
SLOTS, DIM, FILTERS, WIDTHS = 1 << 18, 6, 6, (1, 2, 3)
#: Passes over the rows of one shard, and over those of many; the fewer rows a shard has, the more, up to as many ``STEPS`` in sequence.
PASSES, ROUNDS, STEPS, RATE, DECAY, KEEP = 6, 3, 24_000, 0.15, 1e-5, 0.7
#: Changes are summed as whole numbers, so that the model does not depend on the order of shards.
UNIT = 1 << 20
THRESHOLD = 0.7


@dataclass
class Model:
    one: np.ndarray
    two: np.ndarray
    kernels: list[np.ndarray]  # width, DIM, FILTERS
    biases: list[np.ndarray]
    out: np.ndarray
    shift: float
    scale: float = 1.0
    move: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)


def slots(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both slots of every word; each text is followed by as many empty words (slot ``SLOTS``) as the widest filter
    sees. Also the place of each text's first word."""
    w = Words(texts, alnum=True)
    pad = WIDTHS[-1]
    ends = np.repeat(w.first[1:], pad)
    one = np.insert((w.hash % np.uint64(SLOTS)).astype(np.int64), ends, SLOTS)
    two = np.insert(((w.hash >> np.uint64(32)) % np.uint64(SLOTS)).astype(np.int64), ends, SLOTS)
    return one, two, w.first + pad * np.arange(len(w.first))


def _pooled(m: Model, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Maxima of every filter over each text; the last place of a text's padding would look into the next text."""
    out = []
    last = starts[1:] - 1
    for width, kernel, bias in zip(WIDTHS, m.kernels, m.biases):
        z = x @ kernel[0]
        for j in range(1, width):
            z[:-j] += x[j:] @ kernel[j]
        z += bias
        for back in range(WIDTHS[-1]):  # windows that begin in the padding count only for texts without words
            at = last - back
            z[at[(at - starts[:-1]) > 0]] = -np.inf
        out.append(np.maximum(np.maximum.reduceat(z, starts[:-1], axis=0), 0))
    return np.concatenate(out, axis=1)


def logits(m: Model, texts: list[bytes]) -> np.ndarray:
    one, two, starts = slots(texts)
    return _pooled(m, m.one[one] + m.two[two], starts) @ m.out + m.shift


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scores(m: Model, texts: list[bytes]) -> np.ndarray:
    return _sigmoid(logits(m, texts) * m.scale + m.move)


#: Rows of the matrix of all parameters: both tables, then everything else, ``DIM`` numbers a row.
_REST = sum(WIDTHS) * DIM * FILTERS + 2 * len(WIDTHS) * FILTERS + 1
_ROWS = 2 * (SLOTS + 1) + -(-_REST // DIM)


def _model(p: np.ndarray) -> Model:
    """The model whose parameters are views of the matrix ``p``; its shift is a copy of the last of them."""
    rest, at, parts = p[2 * (SLOTS + 1):].reshape(-1), 0, []
    for size in (*(w * DIM * FILTERS for w in WIDTHS), *(FILTERS for _ in WIDTHS), len(WIDTHS) * FILTERS):
        parts.append(rest[at:at + size])
        at += size
    n = len(WIDTHS)
    return Model(p[:SLOTS + 1], p[SLOTS + 1:2 * (SLOTS + 1)], [k.reshape(w, DIM, FILTERS) for w, k in zip(WIDTHS, parts)], parts[n:2 * n], parts[2 * n], float(rest[at]))


def _begin(seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Parameters before any text was met, and the sums of squared gradients that go with them."""
    rng = np.random.default_rng(seed)
    p = np.zeros((_ROWS, DIM), np.float32)
    m = _model(p)
    for table in (m.one, m.two):
        table[:SLOTS] = rng.normal(0, 0.1, (SLOTS, DIM))
    for kernel in m.kernels:
        kernel[:] = rng.normal(0, 0.5, kernel.shape)
    m.out[:] = rng.normal(0, 0.3, m.out.shape)
    return p, np.full_like(p, 1e-2)


def _learn(p: np.ndarray, seen: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]], labels: list[float], passes: int, rng: np.random.Generator) -> None:
    """Adagrad over the words of some texts, ``passes`` times, on both matrices in place."""
    m, sums = _model(p), _model(seen)
    shift_seen = sums.shift

    def step(p: np.ndarray, s: np.ndarray, grad: np.ndarray, rows=None) -> None:
        if rows is None:
            s += grad * grad
            p -= RATE * grad / np.sqrt(s)
        else:
            np.add.at(s, rows, grad * grad)
            np.subtract.at(p, rows, RATE * grad / np.sqrt(s[rows]))

    for _ in range(passes):
        for k in rng.permutation(len(parts)):
            a, b = parts[k]
            kept = rng.random(len(a)) < KEEP  # words are left out at random, so that no single rare one decides
            kept[len(a) - WIDTHS[-1]:] = True
            a, b = a[kept], b[kept]
            x = m.one[a] + m.two[b]
            n = max(1, len(a) - WIDTHS[-1])
            feats, tops = [], []
            for width, kernel, bias in zip(WIDTHS, m.kernels, m.biases):
                z = x[:n] @ kernel[0]
                for j in range(1, width):
                    z = z + x[j:n + j] @ kernel[j]
                z = z + bias
                top = z.argmax(axis=0)
                tops.append(top)
                feats.append(np.maximum(z[top, np.arange(FILTERS)], 0))
            h = np.concatenate(feats)
            g = float(_sigmoid(h @ m.out + m.shift) - labels[k])
            back = g * m.out
            step(m.out, sums.out, g * h + DECAY * m.out)
            shift_seen += g * g
            m.shift -= RATE * g / np.sqrt(shift_seen)
            for i, (width, kernel, bias) in enumerate(zip(WIDTHS, m.kernels, m.biases)):
                d = np.where(feats[i] > 0, back[i * FILTERS:(i + 1) * FILTERS], 0).astype(np.float32)
                if not d.any():
                    continue
                grad = np.empty_like(kernel)
                for j in range(width):
                    at = tops[i] + j
                    grad[j] = (x[at] * d[:, None]).T
                    rows = (kernel[j] * d).T  # filters, DIM
                    live = a[at] < SLOTS
                    step(m.one, sums.one, rows[live], a[at][live])
                    step(m.two, sums.two, rows[live], b[at][live])
                step(kernel, sums.kernels[i], grad + DECAY * kernel)
                step(bias, sums.biases[i], d)
    last = 2 * (SLOTS + 1), _REST - 1
    p[last[0]:].reshape(-1)[last[1]] = m.shift
    seen[last[0]:].reshape(-1)[last[1]] = shift_seen


_CHANGES = [f"{kind}{i}" for kind in "ps" for i in range(DIM)]


def _round(fit_on: DataFrame, p: np.ndarray, seen: np.ndarray, number: int, passes: int) -> None:
    """One round: every shard learns from the same start, in place go the averages of what they changed.

    A row of a table that few shards met is averaged over these. The driver gets one row for each changed row of the matrix, ``_ROWS`` at most.
    """
    start = fit_on.sparkSession.sparkContext.broadcast((p, seen))

    def run(batches):
        before = start.value
        p, seen = before[0].copy(), before[1].copy()
        rng = np.random.default_rng([number, TaskContext.get().partitionId()])
        parts, labels, held = [], [], 0
        for batch in batches:
            told = batch.column("toxic").to_pylist()
            for first, texts in portions(batch, "text"):
                one, two, starts = slots(texts)
                parts += [(one[i:j], two[i:j]) for i, j in zip(starts[:-1], starts[1:])]
                labels += [float(y) for y in told[first:first + len(texts)]]
                held += len(one)
                if held > BLOCK_WORDS:
                    _learn(p, seen, parts, labels, passes, rng)
                    parts, labels, held = [], [], 0
        if parts:
            _learn(p, seen, parts, labels, passes, rng)
        rows = np.flatnonzero((seen != before[1]).any(axis=1))
        for at in range(0, len(rows), 10_000):
            some = rows[at:at + 10_000]
            change = np.hstack([(new[some].astype(float) - old[some]) * UNIT for new, old in ((p, before[0]), (seen, before[1]))])
            yield pa.record_batch([pa.array(some, pa.int64()), *(pa.array(np.rint(c), pa.int64()) for c in change.T)], names=["row", *_CHANGES])

    changes = in_batches(fit_on, run, f"row bigint, {', '.join(f'{c} bigint' for c in _CHANGES)}")
    got = changes.groupBy("row").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in _CHANGES]).toArrow()
    start.destroy()
    rows, n = got["row"].to_numpy(), got["n"].to_numpy()
    mean = np.stack([got[c].to_numpy() / (n * float(UNIT)) for c in _CHANGES], axis=1)
    p[rows] += mean[:, :DIM].astype(np.float32)
    seen[rows] += mean[:, DIM:].astype(np.float32)


#: Logits are counted by their thousandths.
FINE = 1000


def calibrate(m: Model, told: DataFrame) -> None:
    """Logistic calibration by Newton steps, then a threshold per language; languages not met use ``THRESHOLD``.

    From counts of all rows by language, label and logit, the latter to the thousandth and within 30.
    """
    def run(batches):
        for batch in batches:
            for first, texts in portions(batch, "text"):
                z = np.rint(np.clip(logits(m, texts), -30, 30) * FINE)
                yield pa.record_batch([batch.column(c).slice(first, len(texts)) for c in ("lang", "toxic")] + [pa.array(z, pa.int64())], names=["lang", "toxic", "z"])

    got = in_batches(told.select("text", F.coalesce("lang", F.lit("")).alias("lang"), F.col("toxic").cast("double").alias("toxic")), run,
                     "lang string, toxic double, z bigint").groupBy("lang", "toxic", "z").agg(F.count("*").alias("n")).orderBy("lang", "z", "toxic").toArrow()
    if not got.num_rows:
        return
    z, n, labels = got["z"].to_numpy() / FINE, got["n"].to_numpy().astype(float), got["toxic"].to_numpy()
    x = np.stack((z, np.ones_like(z)), axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ w)
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        w -= np.clip(np.linalg.solve(hess, x.T @ (n * (p - labels)) + 0.1 * (w - [1.0, 0.0])), -0.5, 0.5)
    if w[0] > 0:
        m.scale, m.move = float(w[0]), float(w[1])
    s = np.round(_sigmoid(z * m.scale + m.move), 3)
    lang = np.array(got["lang"].to_pylist())
    for name in sorted(set(lang)):
        own, many, mark = s[lang == name], n[lang == name], (n * labels)[lang == name]
        tries = np.unique(own)
        above = lambda of: np.bincount(np.searchsorted(tries, own), of, len(tries))[::-1].cumsum()[::-1]
        f1 = 2 * above(mark) / np.maximum(1, above(many) + mark.sum())
        m.thresholds[str(name)] = float(tries[int(np.argmax(f1))]) if mark.any() else THRESHOLD


def labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int, int]:
    """(doc_id, text, lang, toxic, tuning) of all labelled documents to learn from, by shards, the number of labels and of shards.

    Null labels and null ids are left out; of rows that share an id the one with the smallest text counts. Texts move once, to the shard of their id.
    """
    told = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(crc_of("doc_id") % 3 != 1)
    n = told.count()
    shards = max(1, -(-n // SHARD_ROWS))
    texts = docs.where(F.col("doc_id").isNotNull() & (crc_of("doc_id") % 3 != 1)).select("doc_id", "text", "lang").repartition(shards, "doc_id")
    rows = texts.join(told.repartition(shards, "doc_id"), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("r"), F.max("toxic").alias("toxic"))
    tuning = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxicity")), F.lit(3)) == 0
    return rows.select("doc_id", "r.text", "r.lang", "toxic", tuning.alias("tuning")), n, shards


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from all labelled documents whose crc32(doc_id) mod 3 is not 1: two thirds fit the model, one third calibrates it."""
    rows, n, shards = labelled(docs, labels)
    rows = rows.persist(StorageLevel.DISK_ONLY)
    p, seen = _begin()
    fit_on = rows.where(~F.col("tuning")).select("text", "toxic")
    passes = min(40, max(ROUNDS if shards > 1 else PASSES, STEPS * shards // max(1, n * 2 // 3)))
    # One shard passes over its rows by itself; many meet after every pass.
    for number in range(passes if shards > 1 else 1):
        _round(fit_on, p, seen, number, 1 if shards > 1 else passes)
    m = _model(p)
    calibrate(m, rows.where("tuning"))
    rows.unpersist()
    return m


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, threshold, flagged) for every row, repeated rows included.

    Null and empty texts have no words and one and the same score. ``predicted`` uses ``THRESHOLD`` for all; ``flagged`` uses
    the threshold of the row's language, which is ``THRESHOLD`` for null or unknown ones.
    """
    small = Model(model.one.astype(np.float16), model.two.astype(np.float16), model.kernels, model.biases, model.out, model.shift,
                  model.scale, model.move, model.thresholds)

    def run(batches):
        m = Model(small.one.astype(np.float32), small.two.astype(np.float32), small.kernels, small.biases, small.out, small.shift, small.scale, small.move)
        for batch in batches:
            for first, texts in portions(batch, "text"):
                s = scores(m, texts).astype(float)
                yield pa.record_batch([batch.column(0).slice(first, len(texts)), batch.column(2).slice(first, len(texts)),
                                       batch.column(3).slice(first, len(texts)), pa.array(s, pa.float64())], names=["doc_id", "lang", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", (crc_of("doc_id") % 3 == 1).alias("held_out"))
    scored = in_batches(rows, run, "doc_id bigint, lang string, held_out boolean, score double")
    at = F.lit(THRESHOLD)
    for name, value in model.thresholds.items():
        at = F.when(F.coalesce("lang", F.lit("")) == name, F.lit(value)).otherwise(at)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                         at.alias("threshold"), (F.col("score") >= at).alias("flagged"))
