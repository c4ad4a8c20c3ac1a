"""Exact top-k search by inner product: a dual-tree search over one cover tree of queries and data.

1. The tree's upper level is a net of at most ``CELLS`` vectors, chosen farthest first among a sample of ``SAMPLE``; only this sample
   reaches the driver. Every vector goes to the cell of its nearest centre; the covering radius of a cell is measured over all its vectors.
2. Cells are dealt into blocks of about ``block_rows`` vectors, so a cell of any size is shared by tasks. A task splits its block
   farthest first again: at each level centres lie at least as far apart as the radius that covers their vectors, down to
   leaves of ``LEAF`` vectors at most. The queries among them, in nodes of their own, are searched in their block, which gives each a kth score.
3. A query node with centre q and radius s meets a data node with centre c and radius r only if qc + |q| r + |c| s + rs reaches the
   node's worst kth score: first cells, then, in the task of each block, leaves, best bound first, where the worst kth score rises
   as leaves are compared. Query nodes travel to the blocks of the cells that are left; blocks stay where they are.
4. A query keeps its ``k`` best of each block, and of these the best ``k``.

Bounds use measured radii and are rounded up, so nothing is lost by the sample: results are exact. On vectors without clusters few pairs are
pruned and the work is that of all queries against all rows, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import in_batches, written

SCALE, K, EVERY = 1024, 10, 100
SAMPLE, CELLS, FAN, LEAF, QUERY_LEAF = 2048, 256, 16, 64, 32
LEAST_ROWS, MOST_ROWS, BLOCKS = 1024, 16384, 64
#: Vectors compared with a query node between two updates of its kth scores.
STRIDE = 1024
NONE = -2**63


def block_rows(n: int) -> int:
    """Vectors of a block: a small table is dealt into ``BLOCKS`` or so, a large one into blocks that fit a task."""
    return min(MOST_ROWS, max(LEAST_ROWS, n // BLOCKS))


def _matrix(lists: pa.Array | pa.ChunkedArray, least: int = 0) -> np.ndarray:
    """Rows of equal length, shorter vectors filled with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), max(least, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _wide(m: np.ndarray, d: int) -> np.ndarray:
    return m if m.shape[1] >= d else np.pad(m, ((0, 0), (0, d - m.shape[1])))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows; beyond 64 bits the largest or smallest number of 64 bits."""
    d = max(a.shape[1], b.shape[1])
    a, b = _wide(a, d), _wide(b, d)
    most = d * max(map(abs, (int(a.max(initial=0)), int(a.min(initial=0))))) * max(map(abs, (int(b.max(initial=0)), int(b.min(initial=0)))))
    if most < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if most < 2**63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -2**63, 2**63 - 1).astype(np.int64)


def _apart(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Distances, rounded up."""
    points, centre = points.astype(float), centre.astype(float)
    x = points - centre
    lost = 1e-12 * np.sqrt(len(centre)) * (np.abs(points).max(initial=0) + np.abs(centre).max(initial=0))  # by rounding
    return np.sqrt(np.einsum("ij,ij->i", x, x)) * (1 + 1e-9) + lost


def net(points: np.ndarray, most: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(centres, nearest centre of each point, its distance): farthest first, until half the first radius covers all or there are ``most``."""
    centres, near, far = [0], np.zeros(len(points), np.int64), _apart(points, points[0])
    half = far.max(initial=0) / 2
    while len(centres) < most and far.max(initial=0) > max(half, 1e-9 * np.abs(points).max(initial=0)):
        centres.append(int(far.argmax()))
        d = _apart(points, points[centres[-1]])
        near[d < far] = len(centres) - 1
        far = np.minimum(far, d)
    return centres, near, far


def leaves(points: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, float]]:
    """(places, radius) of the leaves of a tree over ``points``, the centre's place first."""
    todo = [np.arange(len(points))] if len(points) else []
    while todo:
        held = todo.pop()
        own = points[held]
        centres, near, far = net(own, FAN) if len(held) > size else ([0], np.zeros(len(held), np.int64), _apart(own, own[0]))
        if len(centres) == 1:  # small enough, or equal vectors
            for i in range(0, len(held), size):
                part = held[i:i + size]
                yield part, float(_apart(points[part], points[part[0]]).max())
            continue
        todo += [held[near == c] for c in range(len(centres))]


@dataclass
class Block:
    """Vectors of a block in the order of its leaves."""

    ids: np.ndarray
    rows: np.ndarray
    vectors: np.ndarray
    first: np.ndarray  # of each leaf, and the end
    radius: np.ndarray

    def __post_init__(self):
        self.centres = self.vectors[self.first[:-1]].astype(float)
        self.norm = np.sqrt((self.centres**2).sum(axis=1))


def bounds(centre: np.ndarray, radius: float, centres: np.ndarray, norms: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """What no product between vectors of a query node and of the data nodes can pass."""
    d = max(len(centre), centres.shape[1])
    centre, centres = np.pad(centre.astype(float), (0, d - len(centre))), _wide(centres, d)
    norm = float(np.sqrt(centre @ centre))
    size = norm * norms + norm * radii + norms * radius + radius * radii
    return centres @ centre + (size - norm * norms) + 1e-9 * size + 1


def search(block: Block, ids: np.ndarray, vectors: np.ndarray, radius: float, kth: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each query of a node its best places in ``block``, and the kth scores that are then known.

    Scores below the kth already known are left out. Order: score, smaller id, row.
    """
    kth, best = kth.copy(), [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
    reach = bounds(vectors[0], radius, block.centres, block.norm, block.radius)
    order = np.argsort(-reach, kind="stable")
    while len(order):
        order = order[reach[order] >= kth.min()]
        size = np.cumsum(block.first[order + 1] - block.first[order])
        now, order = np.split(order, [int(np.searchsorted(size, STRIDE)) + 1])
        places = np.concatenate([np.arange(block.first[x], block.first[x + 1]) for x in now]) if len(now) else np.zeros(0, np.int64)
        if not len(places):
            continue
        found = products(vectors, block.vectors[places])
        for i, own in enumerate(ids):
            good = np.flatnonzero((found[i] >= kth[i]) & (block.ids[places] != own))
            if not len(good):
                continue
            at, scores = np.concatenate((best[i][0], places[good])), np.concatenate((best[i][1], found[i][good]))
            top = np.lexsort((block.rows[at], block.ids[at], ~scores))[:k]  # ~x falls as x rises, without overflow
            best[i] = at[top], scores[top]
            if len(top) == k:
                kth[i] = max(kth[i], scores[top[-1]])
    return best, kth


_INDEX = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64())), ("vectors", pa.list_(pa.int64())),
                    ("radius", pa.float64()), ("kth", pa.list_(pa.int64())), ("cells", pa.list_(pa.int32()))])
_INDEX_DDL = "block bigint, kind int, ids array<bigint>, rows array<bigint>, vectors array<bigint>, radius double, kth array<bigint>, cells array<int>"


def _grow(k: int, centres: np.ndarray, radii: np.ndarray):
    """Rows of kind 0, a block's leaves, and of kind 1, its query nodes, with the cells that these must meet."""
    norms = np.sqrt((centres.astype(float)**2).sum(axis=1))

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        vectors, ids, rows = _matrix(group["v"]), group["vec_id"].to_numpy(), group["row"].to_numpy()
        asks = group["asks"].to_numpy()
        parts = list(leaves(vectors, LEAF))
        order = np.concatenate([p for p, _ in parts])
        block = Block(ids[order], rows[order], vectors[order], np.concatenate(([0], np.cumsum([len(p) for p, _ in parts]))), np.array([r for _, r in parts]))
        head = {"block": group["block"][0].as_py()}
        out = [head | {"kind": 0, "ids": ids[p], "rows": rows[p], "vectors": vectors[p].ravel(), "radius": r} for p, r in parts]
        asking = np.flatnonzero(asks)
        for p, r in leaves(vectors[asking], QUERY_LEAF):
            p = asking[p]
            kth = search(block, ids[p], vectors[p], r, np.full(len(p), NONE), k)[1]
            cells = np.flatnonzero(bounds(vectors[p[0]], r, centres.astype(float), norms, radii) >= kth.min())
            out.append(head | {"kind": 1, "ids": ids[p], "rows": rows[p], "vectors": vectors[p].ravel(), "radius": r, "kth": kth, "cells": cells})
        return pa.Table.from_pylist([{c: x.tolist() if isinstance(x, np.ndarray) else x for c, x in o.items()} for o in out], _INDEX)

    return run


_FOUND = "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint"


def _meet(k: int):
    """Leaves of a block come first, then the query nodes that meet it."""
    def told(block: Block, row: dict) -> list[tuple]:
        ids = np.array(row["ids"], np.int64)
        best, _ = search(block, ids, np.array(row["vectors"], np.int64).reshape(len(ids), -1), row["radius"], np.array(row["kth"], np.int64), k)
        return [(q, i, v, r, s) for q, i, (at, scores) in zip(row["rows"], row["ids"], best)
                for v, r, s in zip(block.ids[at].tolist(), block.rows[at].tolist(), scores.tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, parts, block = None, [], None
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("block", "kind", "ids", "rows", "vectors", "radius", "kth")}
                if row["block"] != of:
                    of, parts, block = row["block"], [], None
                if row["kind"] == 0:
                    parts.append(row)
                    continue
                if block is None:
                    matrices = [np.array(p["vectors"], np.int64).reshape(len(p["ids"]), -1) for p in parts]
                    block = Block(np.concatenate([p["ids"] for p in parts]), np.concatenate([p["rows"] for p in parts]), np.concatenate(matrices),
                                  np.concatenate(([0], np.cumsum([len(p["ids"]) for p in parts]))), np.array([p["radius"] for p in parts]))
                out += told(block, row)
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=[x.split()[0] for x in _FOUND.split(", ")])

    return run


def _assign(centres: np.ndarray):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"), centres.shape[1])
                wide, near, far = _wide(centres, v.shape[1]), np.zeros(len(v), np.int32), np.full(len(v), np.inf)
                for c in range(len(wide)):
                    d = _apart(v, wide[c])
                    near[d < far] = c
                    far = np.minimum(far, d)
                yield pa.record_batch([*batch.columns, pa.array(near), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    return run


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null for vectors that are null or hold a null or non-finite component."""
    x = F.transform(vector, lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(vector.isNotNull() & F.coalesce(fine, F.lit(False)), F.transform(x, lambda c: F.floor(scale * c).cast("bigint")))


def top_k(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", asks: Column | None = None, k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``asks`` the ``k`` rows of another id with the highest products.

    ``asks``: condition on the columns of ``vectors``, by default that the id is divisible by ``EVERY``. Ties go to the smaller id.
    Vectors that are null or hold null or non-finite components take no part, nor do rows without an id; shorter vectors count as filled with zeros,
    and components and scores beyond 64 bits as the nearest number of 64 bits. Repeated rows are rows of their own, as candidates and as
    queries; no row of a query's own id is its candidate. An empty table gives no rows; other columns are not read.
    """
    asks = F.col(vec_id) % EVERY == 0 if asks is None else asks
    spark = vectors.sparkSession
    found = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), quantised(F.col(vector), scale).alias("v"), F.coalesce(asks, F.lit(False)).alias("asks"))
    found = found.where("vec_id IS NOT NULL AND v IS NOT NULL")
    n = found.count()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    rows = block_rows(n)
    sample = _matrix(pa.array([x["v"] for x in found.select("vec_id", "v").orderBy(F.xxhash64("vec_id", "v")).limit(SAMPLE).collect()], pa.list_(pa.int64())))
    chosen, _, _ = net(sample.astype(float), min(CELLS, -(-n // rows)))
    centres = sample[chosen]
    numbered = found.withColumn("row", F.monotonically_increasing_id())
    placed = written(in_batches(numbered, _assign(centres), "vec_id bigint, v array<bigint>, asks boolean, row bigint, cell int, far double"), "placed")
    sizes, radii = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for x in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect():  # CELLS rows at most
        sizes[x["cell"]], radii[x["cell"]] = x["n"], x["far"]
    parts = F.array(*(F.lit(int(-(-s // rows)) or 1) for s in sizes))
    block = F.col("cell").cast("bigint") * 2**32 + F.pmod(F.xxhash64("row"), F.get(parts, F.col("cell")))
    grown = placed.withColumn("block", block).select("block", "vec_id", "row", "v", "asks").groupBy("block").applyInArrow(_grow(k, centres, radii), _INDEX_DDL)
    index = written(grown, "cover_tree")
    sent = index.where("kind = 1").withColumn("cell", F.explode("cells")).withColumn("part", F.explode(F.sequence(F.lit(0), F.get(parts, F.col("cell")) - 1)))
    sent = sent.withColumn("block", F.col("cell").cast("bigint") * 2**32 + F.col("part")).select(*index.columns)
    meeting = index.where("kind = 0").union(sent).drop("cells").repartition("block").sortWithinPartitions("block", "kind")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    best = in_batches(meeting, _meet(k), _FOUND).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
