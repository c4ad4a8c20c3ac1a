"""Cross-tokenizer alignment: where two tokenizers cut a text alike, and which of their tokens share bytes.

1. Both tokenizers encode a portion of texts into Arrow lists. ``list_flatten`` gives all tokens, ``list_parent_indices`` the
   document of each; cumulative sums of byte lengths, less their value at the document's start, give the places where tokens end.
2. A full outer Acero join on (document, end) gives all ends of either side. Between two neighbouring ends lies a
   piece of exactly one token of either side, and two tokens that overlap share exactly one such piece: the rows of the join are the
   links. Ends that both sides have cut the tokens into groups.
3. Links of a block of texts are summed up by ``Table.group_by``; Spark adds the partial counts of all blocks, one row per block and
   pair of ids. Each pair's count over the corpus, and whether it is the highest of its B id, goes back to the blocks by a join on
   the pair, where the links of each document are summed.

Tables between the steps are Parquet in the shared folder. A block holds about ``BLOCK_BYTES`` of text, so nothing in a task grows with
the corpus; the table of counts is bounded by the product of both vocabularies and is shuffled, never broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.arrays import portions
from folioflow.llm.common import in_batches, written

A, B = "byte_bpe_50k", "piece_bpe_32k"
BLOCK_BYTES = 4 << 20
#: Text of these code points is not left to the faster library for byte-level pairs, which knows another version of Unicode.
_RARE = re.compile("[ɐ-\U0010ffff]")


class ByteLevel:
    """A byte-level vocabulary that two libraries hold: ``<name>.json`` and the same as ranks."""

    def __init__(self, name: str):
        import tiktoken

        self.file = public_tokenizers.path(f"{name}.json")
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        by_id = {i: b for b, i in ranks.items()}
        self.bytes = pa.array([by_id.get(i, b"") for i in range(max(by_id) + 1)], pa.binary())

    @cached_property
    def exact(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.file)
        made.no_truncation()
        made.no_padding()
        made.encode_special_tokens = True
        return made

    def encode(self, texts: list[str]) -> list:
        return [self.exact.encode(t, add_special_tokens=False).ids if _RARE.search(t) else self.fast.encode_ordinary(t)
                for t in (" " + t for t in texts)]


class Pieces:
    """A sentencepiece vocabulary; the library puts a space before each text itself."""

    def __init__(self, name: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name}.model"))
        held = ((self.model.is_byte(i), self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
        self.bytes = pa.array([bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for byte, p in held], pa.binary())

    def encode(self, texts: list[str]) -> list:
        return self.model.encode(texts, num_threads=1)


@cache
def tokenizer(name: str):
    return ByteLevel(name) if name.startswith("byte_") else Pieces(name)


def _lists(ids: list, keep: list[bool] | None = None) -> pa.ListArray:
    ids = ids if keep is None else [x if k else [] for x, k in zip(ids, keep)]
    first = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(first), pa.array(np.concatenate([np.asarray(x, np.int32) for x in ids]) if ids else [], pa.int32()))


def _spelled(side, ids: list, texts: list[bytes]) -> list[bool]:
    """Whether the joined bytes of each list are a space and the text."""
    lists = _lists(ids)
    taken = side.bytes.take(lists.flatten())
    ends = np.frombuffer(taken.buffers()[1], np.int32)[:len(taken) + 1] if len(taken) else np.zeros(1, np.int32)
    places, data = ends[lists.offsets.to_numpy()], taken.buffers()[2].to_pybytes() if len(taken) else b""
    return [data[a:b] == b" " + t for a, b, t in zip(places[:-1], places[1:], texts)]


def _tokens(side, lists: pa.ListArray, name: str) -> pa.Table:
    """(doc, end, id, <name>: number of the token) of all tokens of a portion; ``end`` in bytes from the document's start."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    upto = pc.cumulative_sum(pc.binary_length(side.bytes).cast(pa.int64()).take(ids))
    before = np.concatenate(([0], upto.to_numpy()))[lists.offsets.to_numpy()[:-1]]
    return pa.table({"doc": doc, "end": pc.subtract(upto, pa.array(before, pa.int64()).take(doc)), "id": ids, name: pa.array(np.arange(len(ids), dtype=np.int64))})


def portion(texts: list[bytes], a: str, b: str) -> dict[str, np.ndarray]:
    """All tokens and links of some texts.

    ``a``, ``b``: token ids of all texts, ``a_doc``, ``b_doc`` their documents, ``a_group``, ``b_group`` their groups, counted over all texts;
    ``doc``, ``end``, ``link_a``, ``link_b``, ``both``: document, place, token numbers of each link, and whether a group ends there.
    """
    words, sides = [t.decode("utf-8") for t in texts], (tokenizer(a), tokenizer(b))
    ids = [[x if t else [] for x, t in zip(side.encode(words), texts)] for side in sides]
    keep = [x and y and bool(t) for x, y, t in zip(_spelled(sides[0], ids[0], texts), _spelled(sides[1], ids[1], texts), texts)]
    left, right = (_tokens(side, _lists(x, keep), name) for side, x, name in zip(sides, ids, "ab"))
    ends = left.select(["doc", "end", "a"]).join(right.select(["doc", "end", "b"]), ["doc", "end"], join_type="full outer", use_threads=False)
    ends = ends.take(np.lexsort((ends["end"].to_numpy(), ends["doc"].to_numpy()))).combine_chunks()
    in_a, in_b = (pc.is_valid(ends[c]).to_numpy() for c in "ab")
    both = in_a & in_b
    group = np.cumsum(both) - both
    covering = {f"link_{c}": pc.fill_null_backward(ends[c]).to_numpy() for c in "ab"}  # a token ends at, or after, the pieces it holds
    return {"a": left["id"].to_numpy(), "b": right["id"].to_numpy(), "a_doc": left["doc"].to_numpy(), "b_doc": right["doc"].to_numpy(),
            "a_group": group[in_a], "b_group": group[in_b], "doc": ends["doc"].to_numpy(), "end": ends["end"].to_numpy(), "both": both} | covering


def _digits(n: int) -> np.ndarray:
    """Decimal digits of 0 .. n-1 as bytes, zero bytes before."""
    width = len(str(n))
    made = np.frombuffer("".join(str(i).rjust(width, "\0") for i in range(n)).encode(), np.uint8)
    return made.reshape(n, width)


_DIGITS: dict[int, np.ndarray] = {}


def spelled_groups(p: dict[str, np.ndarray], docs: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` for each text, empty without tokens."""
    n = max(p["a"].max(initial=0), p["b"].max(initial=0)) + 1
    if not _DIGITS or len(_DIGITS[0]) < n:
        _DIGITS[0] = _digits(1 << int(n).bit_length())
    digits = _DIGITS[0]
    ga, gb = p["a_group"], p["b_group"]
    at_a = np.arange(len(ga)) + np.searchsorted(gb, ga, "left")
    at_b = np.arange(len(gb)) + np.searchsorted(ga, gb, "right")
    rows = np.zeros((len(ga) + len(gb), digits.shape[1] + 1), np.uint8)
    last = lambda g: np.append(g[1:] != g[:-1], True)[:len(g)]
    rows[at_a, :-1], rows[at_b, :-1] = digits[p["a"]], digits[p["b"]]
    rows[at_a, -1], rows[at_b, -1] = np.where(last(ga), ord("|"), ord(",")), np.where(last(gb), ord(";"), ord(","))
    sizes = np.concatenate(([0], np.cumsum((rows != 0).sum(axis=1))))
    tokens = np.cumsum(np.bincount(p["a_doc"], minlength=docs) + np.bincount(p["b_doc"], minlength=docs))
    data, places = rows[rows != 0].tobytes(), np.concatenate(([0], sizes[tokens])) if docs else np.zeros(1, np.int64)
    return [data[x:y - 1] if y > x else b"" for x, y in zip(places[:-1], places[1:])]


_DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_BLOCK = pa.schema([("block", pa.int64()), ("docs", pa.list_(pa.struct([(n, pa.string() if t == "string" else pa.int64()) for n, t in map(str.split, _DOC.split(", "))]))),
                    ("pairs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))), ("links", pa.binary())])


def _block(docs: list[dict], doc: list[np.ndarray], a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    """One row: results of documents, counts of the block's pairs, and each document's pairs as places among these.

    Places are sorted within documents, which their sums do not mind, and stored as differences, which are small.
    """
    links = pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})
    pairs = links.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).sort_by([("count_all", "descending")]).combine_chunks()
    code = lambda t: pc.add(pc.multiply(t["a"].cast(pa.int64()), 1 << 31), t["b"].cast(pa.int64()))
    place = pc.index_in(code(links), value_set=code(pairs).combine_chunks()).to_numpy()
    key = np.sort(np.concatenate(doc).astype(np.int64) * max(1, len(pairs)) + place)
    links = zstandard.compress(np.diff(key, prepend=0).astype("<u4").tobytes(), 3)
    counted = pa.StructArray.from_arrays([pairs[c].combine_chunks().cast(t) for c, t in (("a", pa.int32()), ("b", pa.int32()), ("count_all", pa.int64()))], ["a", "b", "n"])
    return pa.record_batch([pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([docs], _BLOCK.field("docs").type),
                            pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), counted), pa.array([links], pa.binary())], schema=_BLOCK)


def _blocks(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, doc, left, right, size = [], [], [], [], 0
        for batch in batches:
            for first, texts in portions(batch, "text"):
                p, n = portion(texts, a, b), len(texts)
                per = [np.bincount(x, minlength=n).tolist() for x in (p["a_doc"], p["b_doc"], p["doc"][p["both"]], p["doc"])]
                doc.append(p["doc"].astype(np.int32) + len(docs))
                left.append(p["a"][p["link_a"]])
                right.append(p["b"][p["link_b"]])
                for i, na, nb, ng, nl, said in zip(batch.column(0).slice(first, n).to_pylist(), *per, spelled_groups(p, n)):
                    docs.append({"doc_id": i, "n_a": na, "n_b": nb, "n_groups": ng, "n_links": nl, "groups_sha256": hashlib.sha256(said).hexdigest() if said else ""})
                size += sum(map(len, texts))
                # Short and empty texts count too, and so do differences of places, which have 32 bits.
                if size + 100 * len(docs) >= BLOCK_BYTES:
                    yield _block(docs, doc, left, right)
                    docs, doc, left, right, size = [], [], [], [], 0
        if docs:
            yield _block(docs, doc, left, right)

    return run


_RESULT = _DOC.replace(", groups_sha256", ", n_best bigint, count_sum bigint, groups_sha256")


def _sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """Counts of a block's pairs summed over the links of its documents."""
    names = [x.split()[0] for x in _RESULT.split(", ")]
    out = []
    for row in left.to_pylist():
        docs, n = row["docs"], [d["n_links"] for d in row["docs"]]
        count, best = np.zeros(max(1, right.num_rows), np.int64), np.zeros(max(1, right.num_rows), np.int64)
        at = right["place"].to_numpy()
        count[at], best[at] = right["count"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        key = np.cumsum(np.frombuffer(zstandard.decompress(row["links"]), "<u4").astype(np.int64))
        place, first = key % len(count), np.concatenate(([0], np.cumsum(n)))
        for name, of in (("count_sum", count), ("n_best", best)):
            upto = np.concatenate(([0], np.cumsum(of[place])))[first]
            for d, v in zip(docs, np.diff(upto).tolist()):
                d[name] = v
        out += [{k: d[k] for k in names} for d in docs]
    return pa.Table.from_pylist(out, pa.schema([(k, pa.string() if k == "groups_sha256" else pa.int64()) for k in names]))


class Alignment:
    """The alignment of two tokenizers over all texts of ``docs``.

    Null, empty and repeated texts: a row each; texts that are null or empty, or that either tokenizer does not spell out byte by byte
    (with a space before), have no tokens, zeros and an empty digest. A null id stays null. Empty tables give no rows. Other
    columns of ``docs`` are not read. Ties: all pairs of the highest count of a B id are its best.
    """

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str = A, b: str = B):
        self.docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        self.a, self.b = a, b

    @cached_property
    def _blocks(self) -> DataFrame:
        made = in_batches(self.docs, _blocks(self.a, self.b), f"block bigint, docs array<struct<{_DOC.replace(' ', ':').replace(',:', ',')}>>, pairs array<struct<a:int,b:int,n:bigint>>, links binary")
        return written(made, "blocks")

    def _pairs(self) -> DataFrame:
        return self._blocks.select("block", F.posexplode("pairs").alias("place", "pair")).select("block", "place", "pair.a", "pair.b", "pair.n")

    @cached_property
    def pairs(self) -> DataFrame:
        """(a, b, count, best): how many links of the corpus hold an A id and a B id, and whether no A id has more with that B id."""
        counts = self._pairs().groupBy("a", "b").agg(F.sum("n").alias("count"))
        # Partial maxima make one row per B id and task of it; a B id has at most as many pairs as the A vocabulary has ids.
        most = counts.groupBy("b").agg(F.max("count").alias("most"))
        return written(counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")), "pair_counts")

    def documents(self) -> DataFrame:
        """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
        told = self._pairs().select("block", "place", "a", "b").join(self.pairs, ["a", "b"]).select(F.col("block").alias("of"), "place", "count", "best")
        return self._blocks.select("block", "docs", "links").groupBy("block").cogroup(told.groupBy("of")).applyInArrow(_sums, _RESULT)

    def groups(self) -> DataFrame:
        """(doc_id, start, end, a_ids, b_ids): every group, by its bytes in the text with a space before."""
        names = (self.a, self.b)

        def run(batches):
            for batch in batches:
                for first, texts in portions(batch, "text"):
                    p = portion(texts, *names)
                    doc, end = p["doc"][p["both"]], p["end"][p["both"]]
                    start = np.concatenate(([0], np.where(doc[1:] == doc[:-1], end[:-1], 0)))[:len(end)]
                    lists = [pa.ListArray.from_arrays(pa.array(np.searchsorted(p[f"{c}_group"], np.arange(len(end) + 1)), pa.int32()), pa.array(p[c], pa.int32())) for c in "ab"]
                    yield pa.record_batch([batch.column(0).slice(first, len(texts)).take(pa.array(doc)), pa.array(start, pa.int64()), pa.array(end, pa.int64()), *lists],
                                          names=["doc_id", "start", "end", "a_ids", "b_ids"])

        return in_batches(self.docs, run, "doc_id bigint, start bigint, end bigint, a_ids array<int>, b_ids array<int>")
