"""Words of many texts as numpy arrays of hashes, for operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 19)
        both = []
        for b in (_BASE, pow(_BASE, -1, 2**64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[:] = both
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def portions(batch: pa.RecordBatch, text: str, size: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8) in portions of about ``size`` bytes; null counts as empty."""
    first, held, total = 0, [], 0
    column = batch.column(batch.schema.get_field_index(text))
    for i, value in enumerate(column):
        raw = value.as_buffer().to_pybytes() if value.is_valid else b""
        held.append(raw)
        total += len(raw)
        if total >= size:
            yield first, held
            first, held, total = i + 1, [], 0
    if held:
        yield first, held


class Words:
    """Words of some texts, A-Z lower-cased: 64-bit hashes in order, and where each text's begin.

    Words stand between white space, or with ``alnum`` between all ASCII but letters and digits.
    ``start`` and ``end`` are byte places in ``data``, the texts joined by line feeds.
    """

    def __init__(self, texts: list[bytes], alnum: bool = False):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        space = (_NOT_ALNUM if alnum else _SPACE)[self.data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        power, inverse = _powers(len(self.data))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[self.data] * power)))
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start])
        text_end = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.concatenate(([0], np.searchsorted(self.start, text_end)))
