"""Byte-pair encoding and decoding that reuses content-defined chunks.

1. A rolling hash over the bytes cuts every text into chunks; equal passages are cut alike wherever they stand.
   Only (document, chunk hash) pairs are shuffled. A chunk met more than once is shared; one document owns it.
2. Texts without shared chunks are encoded where they are read. Owners encode the chunks they own, once.
3. Documents with shared chunks get the ids of those by joins, encode the rest, and repair the joins between pieces.

A place is safe if a blank follows a visible ASCII character: no pre-token of the byte-level pattern spans it, and none looks
across it. Pieces that meet at a safe place agree as they are. Others are re-encoded from the last safe place
before to the first one after the join; both sides then agree exactly. Every result is decoded; should it differ
from the text (two chunks with one 64-bit hash), the whole text is encoded anew.

Two libraries hold the vocabulary: text of the first 592 code points, where both split alike (tested for every one), goes to
the faster, all else to the one whose results are asked for.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.arrays import _BYTE, _powers, mix, portions
from folioflow.llm.common import in_batches, small, written

VOCABULARY = "byte_bpe_50k"
#: The most shared chunks, counted once per document that has them, that are sent to every executor: 32 bytes each, 64 MB.
BROADCAST_CHUNKS = 2_000_000
#: Bytes the rolling hash sees; one safe place in ``SAFE_CUT`` and one character in ``ANY_CUT`` is a cut.
WINDOW, SAFE_CUT, ANY_CUT = 24, 128, 1 << 16
_SAFE = re.compile(rb"(?<=[!-~]) ")
_RARE = re.compile("[ɐ-\U0010ffff]")


class Encoder:
    """Text to ids and back, as the tokenizers library does for the vocabulary file, special tokens included."""

    def __init__(self, name: str):
        import tiktoken

        self.file = public_tokenizers.path(f"{name}.json")
        with open(self.file) as f:
            self.special = {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.dtype = "<u2" if max([*ranks.values(), *self.special.values()]) < 1 << 16 else "<u4"
        self.bytes: dict[int, bytes] = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        self.lengths = np.zeros(max(self.bytes) + 1, np.int64)
        self.lengths[list(self.bytes)] = [len(b) for b in self.bytes.values()]

    @cached_property
    def exact(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.file)
        made.no_truncation()
        made.no_padding()
        return made

    def encode(self, raw: bytes) -> np.ndarray:
        text = raw.decode("utf-8")
        if _RARE.search(text) or any(s in text for s in self.special):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))

    def at(self, ids: np.ndarray, place: int) -> int:
        """Index of the id that begins at a byte place."""
        return int(np.searchsorted(np.cumsum(self.lengths[ids]), place, "right")) if place else 0

    def join(self, pieces: list[tuple[bytes, np.ndarray]]) -> np.ndarray:
        """Ids of the concatenation of encoded pieces."""
        raw, parts = pieces[0][0], [pieces[0][1]]
        for text, ids in pieces[1:]:
            if not (text[:1] == b" " and b"!" <= raw[-1:] <= b"~"):
                left = np.concatenate(parts)
                a = max((m.start() for m in _SAFE.finditer(raw)), default=0)
                found = _SAFE.search(text)
                b = found.start() if found else len(text)
                parts = [left[:self.at(left, a)], self.encode(raw[a:] + text[:b])]
                ids = ids[self.at(ids, b):]
            raw += text
            parts.append(ids)
        return np.concatenate(parts)


@cache
def encoder(name: str) -> Encoder:
    return Encoder(name)


def cuts(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text the places its chunks begin, with the end, and the chunks' hashes. Empty texts have no chunk."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    power, inverse = _powers(len(data) + 1)
    # Unlike words, chunks are told apart by case: the byte values are moved by their own number.
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((_BYTE + np.arange(256, dtype=np.uint64) * np.uint64(0x9E37))[data] * power[:-1])))
    ends = np.cumsum([len(t) for t in texts])
    n = len(data)
    seen = np.zeros(n, np.uint64)
    if n > WINDOW:
        seen[WINDOW:] = mix((total[WINDOW:-1] - total[:-WINDOW - 1]) * inverse[:n - WINDOW])
    safe = np.zeros(n, bool)
    safe[1:] = (data[1:] == 32) & (data[:-1] > 32) & (data[:-1] < 127)
    begins = (data & 0xC0) != 0x80
    cut = np.flatnonzero((safe & (seen % np.uint64(SAFE_CUT) == 0)) | (begins & (seen % np.uint64(ANY_CUT) == 1)))
    out = []
    for end, text in zip(ends, texts):
        start = end - len(text)
        if not text:
            out.append((np.zeros(1, np.int64), np.zeros(0, np.int64)))
            continue
        inside = cut[np.searchsorted(cut, start + WINDOW):np.searchsorted(cut, end)]
        place = np.concatenate(([start], inside, [end]))
        hashes = mix((total[place[1:]] - total[place[:-1]]) * inverse[place[:-1]] + np.diff(place).astype(np.uint64))
        out.append((place - start, hashes.view(np.int64)))
    return out


def _cut(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for first, texts in portions(batch, "text"):
            yield pa.record_batch([batch.column(0).slice(first, len(texts)),
                                   pa.array([np.unique(h) for _, h in cuts(texts)], pa.list_(pa.int64()))], names=["key", "chunks"])


def _pieces(raw: bytes, place: np.ndarray, hashes: np.ndarray, apart: set[int]) -> list[tuple[bytes, int | None]]:
    """Chunks of ``apart`` alone with their hash; what stands between them in one."""
    out: list[tuple[bytes, int | None]] = []
    since = 0
    for a, b, h in zip(place[:-1].tolist(), place[1:].tolist(), hashes.tolist()):
        if h in apart:
            if since < a:
                out.append((raw[since:a], None))
            out.append((raw[a:b], h))
            since = b
    if since < len(raw) or not out:
        out.append((raw[since:], None))
    return out


_FIRST = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("ids_sha256", pa.string()),
                    ("decoded_sha256", pa.string()), ("text", pa.string()), ("shared", pa.list_(pa.int64())), ("chunk", pa.int64())])


def _result(enc: Encoder, raw: bytes, ids: np.ndarray, with_ids: bool) -> dict:
    back = enc.decode(ids)
    if back != raw:
        ids = enc.encode(raw)
        back = enc.decode(ids)
    return {"n_tokens": len(ids), "ids": ids.astype("<u4").tobytes() if with_ids else None,
            "ids_sha256": hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), "decoded_sha256": hashlib.sha256(back).hexdigest()}


def _encode(name: str, with_ids: bool):
    """Whole results of documents without shared chunks or that own all of theirs; the owned chunks; the rest as it is."""
    def run(batches):
        enc = encoder(name)
        for batch in batches:
            ids, keys, needs = batch.column(0), batch.column(1), batch.column(3)
            for first, texts in portions(batch, "text"):
                part = slice(first, first + len(texts))
                wants = [{x["chunk"]: x["own"] for x in (n or ())} for n in needs.slice(first, len(texts)).to_pylist()]
                rows = []
                cut = iter(cuts([t for t, w in zip(texts, wants) if w]))
                for doc, key, raw, want in zip(ids[part.start:part.stop].to_pylist(), keys[part.start:part.stop].to_pylist(), texts, wants):
                    head = {"doc_id": doc, "key": key}
                    if not want:
                        rows.append(head | _result(enc, raw, enc.encode(raw), with_ids))
                        continue
                    own, done, whole = {h for h, o in want.items() if o}, {}, all(want.values())
                    pieces = []
                    for t, h in _pieces(raw, *next(cut), set(want)):
                        if h in own and h not in done:
                            done[h] = enc.encode(t)
                            rows.append({"chunk": h, "ids": done[h].astype(enc.dtype).tobytes()})
                        if whole:
                            pieces.append((t, done[h] if h in done else enc.encode(t)))
                    rows.append(head | (_result(enc, raw, enc.join(pieces), with_ids) if whole else {"text": raw.decode(), "shared": list(want)}))
                yield from pa.Table.from_pylist(rows, _FIRST).to_batches()

    return run


_LAST = pa.schema([_FIRST.field(i) for i in (0, 2, 3, 4, 5)])


def _assemble(name: str, with_ids: bool):
    def run(batches):
        enc = encoder(name)
        for batch in batches:
            got = batch.column(2)
            for first, texts in portions(batch, "text"):
                rows = []
                for doc, raw, cut, known in zip(batch.column(0).slice(first, len(texts)).to_pylist(), texts, cuts(texts), got.slice(first, len(texts))):
                    have = {x["chunk"]: np.frombuffer(x["ids"], enc.dtype).astype(np.uint32) for x in (known.as_py() or ())}
                    pieces = [(t, have[h] if h is not None else enc.encode(t)) for t, h in _pieces(raw, *cut, set(have))]
                    rows.append({"doc_id": doc} | _result(enc, raw, enc.join(pieces), with_ids))
                yield from pa.Table.from_pylist(rows, _LAST).to_batches()

    return run


def _ddl(schema: pa.Schema) -> str:
    kind = {pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string", pa.list_(pa.int64()): "array<bigint>"}
    return ", ".join(f"{f.name} {kind[f.type]}" for f in schema)


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) for every row of ``docs``, repeated rows included.

    ``ids`` are little-endian unsigned 32-bit integers (null unless ``with_ids``). Null counts as the empty text, which has no ids.
    A null doc_id stays null. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("key"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    met = written(in_batches(rows.select("key", "text"), _cut, "key bigint, chunks array<bigint>"), "chunks").select("key", F.explode("chunks").alias("chunk"))
    shared = met.groupBy("chunk").agg(F.count("*").alias("n"), F.min("key").alias("owner")).where("n > 1").select("chunk", "owner")
    needs = met.distinct().join(shared, "chunk").groupBy("key").agg(
        F.collect_list(F.struct("chunk", (F.col("owner") == F.col("key")).alias("own"))).alias("needs"))
    needs = small(written(needs, "needs"), BROADCAST_CHUNKS, "needs")
    first = written(in_batches(rows.join(needs, "key", "left").select("doc_id", "key", "text", "needs"),
                               _encode(vocabulary, with_ids), _ddl(_FIRST)), "encoded")
    waiting = first.where("text IS NOT NULL")
    made = first.where("chunk IS NOT NULL").select("chunk", "ids").dropDuplicates(["chunk"])
    sent = (waiting.select("key", F.explode("shared").alias("chunk")).distinct().join(made, "chunk")
            .groupBy("key").agg(F.collect_list(F.struct("chunk", "ids")).alias("sent")))
    rest = in_batches(waiting.select("doc_id", "key", "text").join(sent, "key", "left").select("doc_id", "text", "sent"),
                      _assemble(vocabulary, with_ids), _ddl(_LAST))
    return first.where("n_tokens IS NOT NULL").select(*_LAST.names).union(rest)


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text."""
    def run(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            texts = [None if x is None else enc.decode(np.frombuffer(x, "<u4")).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return in_batches(encoded.select("doc_id", "ids"), run, "doc_id bigint, text string")
