"""Near-duplicates: MinHash bands, sequential Bayesian verification, exact confirmation.

1. Each text becomes its set of word shingles, as 64-bit hashes, a digest of that set, a signature of ``ROWS * BANDS``
   minima and one bucket key per band. Documents with the same set are one node from here on.
2. Within a bucket of the first bands nodes are linked to its smallest node only, so a group of any size gives linearly
   many candidates. Candidates are verified; components of confirmed links are found. What is still in different components
   of a bucket of any band is linked to a node of the bucket's largest component, again linearly.
3. In buckets that then still hold several components, every node outside the largest one, an outer node, is compared with all nodes
   of other components, in blocks that are dealt to tasks: first by signature, which leaves the nodes with candidates, then these on full
   sets. A node is sent once per block of outer nodes, an outer node also once per block of the bucket: one row each where the outer
   nodes fit one block. A block gives confirmed links only, and none between nodes that earlier ones of the block already join.
4. Verification compares signatures batch by batch. After each, a pair is dropped if the posterior
   probability that its similarity reaches the threshold is below ``MISS`` (uniform prior). Survivors
   are confirmed on their full shingle sets.

A pair at the threshold shares no bucket with probability (1 - 0.8^5)^32 = 3e-6. Shingles are
compared by 64-bit hashes, sets by 128-bit digests; nodes are named by half of these, or by the other half where two sets have the same
first. No candidate is dropped by a cap, and nothing but counters reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.arrays import Words, mix, portions
from folioflow.llm.common import in_batches, written

WIDTH, PERCENT = 5, 80
ROWS, BANDS = 5, 32
MISS = 1e-6
STEP = 32
#: Bands whose buckets are linked first; the other bands then only link what these left apart.
FIRST_BANDS = 4
BLOCK = 512

_RNG = np.random.default_rng(77)
_COMBINE = _RNG.integers(0, 2**64, 16, dtype=np.uint64) | np.uint64(1)
_XOR = _RNG.integers(0, 2**32, (ROWS * BANDS, 1), dtype=np.uint32)
_TIMES = _RNG.integers(0, 2**32, (ROWS * BANDS, 1), dtype=np.uint32) | np.uint32(1)
_ROW = _RNG.integers(0, 2**64, ROWS, dtype=np.uint64) | np.uint64(1)
_BAND = _RNG.integers(0, 2**64, BANDS, dtype=np.uint64)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``width`` are one shingle, none are none."""
    w = Words(texts)
    n = len(w.hash)
    key = np.zeros(max(0, n - width + 1), np.uint64)
    for j in range(width):
        key += w.hash[j:j + len(key)] * _COMBINE[j]
    key = mix(key)
    out = []
    for a, b in zip(w.first[:-1], w.first[1:]):
        if b - a >= width:
            out.append(np.unique(key[a:b - width + 1]))
        elif b > a:
            out.append(mix((w.hash[a:b] * _COMBINE[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """Both halves."""
    whole = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return tuple(int.from_bytes(whole[i:i + 8], "little", signed=True) for i in (0, 8))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of ``ROWS * BANDS`` hashes; taken in pieces, so that memory does not grow with the text."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(ROWS * BANDS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(least, ((x[None, i:i + 1024] ^ _XOR) * _TIMES).min(axis=1), out=least)
    return least


def _features(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("node", pa.int64()), ("half", pa.int64()), ("n", pa.int64()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc_id"), batch.column("hash")
            for first, texts in portions(batch, "text"):
                sets = shingle_sets(texts, width)
                sigs = np.array([signature(s) for s in sets], np.uint32).reshape(-1, ROWS * BANDS)
                bands = mix((mix(sigs.astype(np.uint64)).reshape(-1, BANDS, ROWS) * _ROW).sum(axis=2, dtype=np.uint64) + _BAND)
                full = [len(s) > 0 for s in sets]
                halves = zip(*(digest(s) if f else (None, None) for s, f in zip(sets, full)))
                short = (sigs & 0xFFFF).astype("<u2")
                yield pa.record_batch([
                    ids.slice(first, len(sets)), hashes.slice(first, len(sets)), *(pa.array(h, pa.int64()) for h in halves),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([b.view(np.int64) if f else None for b, f in zip(bands, full)], pa.list_(pa.int64())),
                    pa.array([s.tobytes() if f else None for s, f in zip(short, full)], pa.binary())], schema=schema)

    return run


@cache
def _least_matches(n: int, percent: int, miss: float) -> int:
    """Fewest of n equal minima at which P(similarity >= threshold) is at least ``miss``.

    With a uniform prior the posterior is a Beta distribution, whose upper tail is a binomial sum.
    """
    t, tail = percent / 100, 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * t**m * (1 - t)**(n + 1 - m)
        if tail >= miss:
            return m
    return n


def may_be_alike(a: np.ndarray, b: np.ndarray, percent: int, miss: float = MISS) -> np.ndarray:
    """For rows of signatures: which pairs are not ruled out, batch of minima by batch."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int32)
    for at in range(0, a.shape[1], STEP):
        equal = equal + (a[alive, at:at + STEP] == b[alive, at:at + STEP]).sum(axis=1, dtype=np.int32)
        ok = equal >= _least_matches(min(at + STEP, a.shape[1]), percent, miss)
        alive, equal = alive[ok], equal[ok]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, ROWS * BANDS)


def _prune(percent: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                ok = may_be_alike(_signatures(batch.column(2)), _signatures(batch.column(3)), percent)
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    return run


def _jaccard(percent: int):
    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _sets(width: int):
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(batches):
        for batch in batches:
            wanted = batch.column(1)
            for first, texts in portions(batch, "text"):
                made = [(w.as_py(), s) for w, s in zip(wanted.slice(first, len(texts)), shingle_sets(texts, width))]
                made = [(w, s) for w, s in made if w in digest(s)]  # another text may have the same doc_id
                for i in range(0, len(made), 256):
                    part = made[i:i + 256]
                    yield pa.record_batch([pa.array([w for w, _ in part], pa.int64()), pa.array([s.tobytes() for _, s in part], pa.binary())], schema=schema)

    return run


def _pair_blocks(compare, schema: pa.Schema):
    """Applies ``compare`` to each run of rows of one (bucket, i, j): the nodes of one or two blocks of a bucket."""
    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            key = [held[c].to_numpy() for c in ("bucket", "i", "j")]
            cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            for a, b in zip(np.concatenate(([0], cut[:-1])), cut):
                yield from compare(held.slice(a, b - a))
            if len(cut):
                held = held.slice(cut[-1])
        if held is not None and held.num_rows:
            yield from compare(held)

    def made(batches):
        for columns in run(batches):
            yield pa.record_batch([pa.array(c) for c in columns], schema=schema)

    return made


def _candidates(part: pa.Table, percent: int):
    """(x, ys): places in ``part`` of an outer node and of nodes in other components whose signatures pass.

    Two nodes may share several buckets; only the first band that they share tells of them.
    """
    comp, outer, left, right = (part[c].to_numpy() for c in ("comp", "outer", "left", "right"))
    node = part["node"].to_numpy()
    sig = _signatures(part["sig"].combine_chunks())
    bands = part["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    band, right = part["band"][0].as_py(), np.flatnonzero(right)
    for x in np.flatnonzero(left):
        y = right[(comp[right] != comp[x]) & (~outer[right] | (node[right] > node[x]))]  # two outer nodes meet twice
        y = y[(bands[y] == bands[x]).argmax(axis=1) == band]
        y = y[may_be_alike(np.broadcast_to(sig[x], (len(y), sig.shape[1])), sig[y], percent)]
        if len(y):
            yield x, y


_NEAR = pa.schema([("bucket", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("node", pa.int64())])


def _near(percent: int):
    """Nodes with a candidate in the block pair."""
    def compare(part: pa.Table):
        places = {int(p) for x, ys in _candidates(part, percent) for p in (x, *ys)}
        if places:
            at = np.array(sorted(places))
            yield [part[c].to_numpy()[at] for c in ("bucket", "i", "j", "node")]

    return _pair_blocks(compare, _NEAR)


def _confirm_blocks(percent: int):
    """Links among the nodes of a block pair, confirmed on full sets; none between nodes that others already join."""
    def compare(part: pa.Table):
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in part["shingles"].combine_chunks()]
        node, comp = part["node"].to_pylist(), part["comp"].to_pylist()
        lead = {c: c for c in comp}

        def top(c):
            while lead[c] != c:
                c = lead[c]
            return c

        found = []
        for x, ys in _candidates(part, percent):
            for y in ys:
                a, b = top(comp[x]), top(comp[y])
                if a != b:
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                        lead[a] = b
                        found.append((node[x], node[y]))
        if found:
            yield list(zip(*found))

    return _pair_blocks(compare, pa.schema([("a", pa.int64()), ("b", pa.int64())]))


#: (i, j, left, right) of the block pairs that a node goes to: as one of the bucket with every block of outer nodes and, if
#: it is outer, as such with every block of the bucket.
_DEALT = """inline(concat(
    transform(sequence(0, outers - 1), x -> named_struct('i', x, 'j', own, 'left', outer AND x = out, 'right', true)),
    filter(transform(sequence(0, blocks - 1), y -> named_struct('i', out, 'j', y, 'left', true, 'right', false)), z -> outer AND z.j <> own)))"""


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, by alternating large-star and small-star steps.

    ``edges``: (a, b). Nodes without an edge do not appear. Each step is one aggregate and one join;
    a table in the shared folder cuts the lineage.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select("b", "a")) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        linked = both.join(least, "a")
        if large:
            return linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = linked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return down.union(least.where("a <> m").select("a", F.col("m").alias("b"))).distinct()

    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = written(edges.where("a <> b").distinct(), "links")
    mark = state(now)
    while mark[0]:
        now = written(star(star(now, True), False), "links")
        before, mark = mark, state(now)
        if before == mark:
            break
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(roots.select("b", "b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Rows with the same set are linked whatever their ids; repeated rows are alike in all columns. Rows without words
    or text have no shingles and their own id as component. Rows without an id are linked with nothing,
    their component is null and they are kept. Ties: the smallest id represents a component. An empty table gives no rows.
    """
    return _judged(docs, doc_id, text, width, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "kept")


def _judged(docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """(doc_id, hash, n, comp, component_id, kept): ``hash`` of the text; ``comp`` tells components apart, as an id may lead several if it is on several texts."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id bigint, hash bigint, node bigint, half bigint, n bigint, bands array<bigint>, sig binary"
    feats = written(in_batches(docs.withColumn("hash", F.xxhash64("text")), _features(width), schema), "features")
    twins = feats.groupBy("node").agg(F.min("half").alias("lo"), F.max("half").alias("hi")).where("lo <> hi").select("node", F.lit(True).alias("twin"))
    if not twins.isEmpty():  # different sets with the same half; some three among 10^10
        feats = written(feats.join(written(twins, "twins"), "node", "left").withColumn("node", F.when(F.col("twin"), F.col("half")).otherwise(F.col("node"))), "features")
    linkable = feats.where("node IS NOT NULL AND doc_id IS NOT NULL")
    banded = linkable.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("bucket", "lo")
    members = written(banded.join(shared, "bucket").select("bucket", "band", "lo", "node").distinct(), "members")
    # Copies are summed up before the shuffle, so that a set that many documents have is no hot key.
    single = linkable.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    nodes = written(single.join(members.select("node").distinct(), "node", "left_semi"), "nodes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes wanted, from the text of one document each."""
        source = wanted.distinct().join(nodes.select("node", "doc_id"), "node")
        texts = docs.join(source, "doc_id").select("doc_id", "node", "text")
        return written(in_batches(texts, _sets(width), "node bigint, shingles binary").dropDuplicates(["node"]), "sets")

    def confirm(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that are alike."""
        s = nodes.select("node", "sig")
        pairs = in_batches(pairs.join(s.select(F.col("node").alias("a"), F.col("sig").alias("x")), "a")
                           .join(s.select(F.col("node").alias("b"), F.col("sig").alias("y")), "b").select("a", "b", "x", "y"),
                           _prune(percent), "a bigint, b bigint")
        pairs = written(pairs, "survivors")
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        return in_batches(pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
                          .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y"),
                          _jaccard(percent), "a bigint, b bigint")

    links = written(confirm(members.where((F.col("node") != F.col("lo")) & (F.col("band") < FIRST_BANDS)).select(F.col("lo").alias("a"), F.col("node").alias("b")).distinct()), "links")
    for last in (False, True):
        comps = written(components(links), "components")
        told = members.select("bucket", "band", "node").join(comps, "node", "left").select("bucket", "band", "node", F.coalesce("comp", "node").alias("comp"))
        each = told.groupBy("bucket", "comp").agg(F.count("*").alias("c"), F.max("node").alias("centre"))
        mixed = each.groupBy("bucket").agg(F.count("*").alias("comps"), F.sum("c").alias("n"), F.max(F.struct("c", "comp", "centre")).alias("main")).where("comps > 1")
        rest = told.join(mixed, "bucket").withColumn("outer", F.col("comp") != F.col("main.comp"))
        if not last:
            pairs = rest.where("outer").select(F.least("node", "main.centre").alias("a"), F.greatest("node", "main.centre").alias("b")).distinct()
            links = written(links.union(confirm(pairs)), "links")
            continue
        dealt = (rest.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("outers", F.ceil((F.col("n") - F.col("main.c")) / BLOCK).cast("int"))
                 .withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("out", F.pmod(F.xxhash64("node"), "outers").cast("int"))
                 .select("bucket", "band", "node", "comp", "outer", F.expr(_DEALT)))

        def in_blocks(rows: DataFrame, run, schema: str, *more: str) -> DataFrame:
            rows = rows.join(nodes.select("node", "sig", "bands"), "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            return in_batches(rows.select("bucket", "i", "j", "band", "left", "right", "outer", "node", "comp", "sig", "bands", *more), run, schema)

        near = written(in_blocks(dealt, _near(percent), "bucket bigint, i int, j int, node bigint"), "near")
        full = dealt.join(near, ["bucket", "i", "j", "node"]).join(sets_of(near.select("node")), "node")
        links = written(links.union(in_blocks(full, _confirm_blocks(percent), "a bigint, b bigint", "shingles")), "links")
    comps = written(components(links), "components")

    classes = linkable.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    led = comps.join(classes, "node").select("node", "comp", "least")
    lead = led.join(led.groupBy("comp").agg(F.min("least").alias("component_id")), "comp").select("node", "comp", "component_id")
    copies = classes.where("rows > 1").join(comps, "node", "left_anti").select("node", F.col("node").alias("comp"), F.col("least").alias("component_id"))
    leads = lead.union(copies)
    key = F.when(F.col("doc_id").isNotNull(), F.col("node"))
    out = feats.select("doc_id", "hash", "n", key.alias("node")).join(leads, "node", "left")
    return out.select("doc_id", "hash", "n", "comp", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each component, all columns as they were; rows repeated with id and text stay once.

    A document is an id and its text: of an id on several texts, only those go that are copies. Of several in one component that its id
    leads, the one of the smallest hash stays.
    """
    judged = written(_judged(docs, "doc_id", "text", width, percent).select("doc_id", "hash", "comp", "kept"), "judged")
    twice = (judged.where("kept AND comp IS NOT NULL").groupBy("doc_id", "comp").agg(F.min("hash").alias("first"), F.max("hash").alias("last"))
             .where("first <> last").select("doc_id", "comp", "first"))
    also = judged.where("kept").join(twice, ["doc_id", "comp"]).where("hash <> first").select("doc_id", "hash")
    dropped = judged.where("NOT kept").select("doc_id", "hash").union(also).select(F.col("doc_id").alias("__gone"), F.col("hash").alias("__gone_hash")).distinct()
    marked = docs.withColumn("__text_hash", F.xxhash64("text"))
    left = marked.join(dropped, (marked["doc_id"] == dropped["__gone"]) & (marked["__text_hash"] == dropped["__gone_hash"]), "left_anti")
    some = left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "__text_hash"])
    return some.union(left.where("doc_id IS NULL")).drop("__text_hash")
