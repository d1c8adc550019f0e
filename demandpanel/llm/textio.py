"""Whole texts as byte arrays, and vectorised hashes of the words in them.

Texts reach Python in Arrow batches. The helpers here cut a batch into chunks of a
megabyte, so that the temporary arrays of a task stay small whatever the batch holds; only a
text that is itself longer makes a longer chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_U = np.uint64
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = _U(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


class Chunk(NamedTuple):
    """Rows ``lo`` to ``hi`` of a batch: their bytes one after another, and where each begins."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of an Arrow column as UTF-8 bytes; a null text counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield Chunk(lo, hi, whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and its inverse modulo 2**64 for i below n."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = (h ^ (h >> _U(32))) * _MIX
    h = (h ^ (h >> _U(29))) * _MIX
    return h ^ (h >> _U(32))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal bytes have equal hashes wherever they stand."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


class Words(NamedTuple):
    """The words of a chunk: document (counted in the chunk), first and last byte, hash."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    lowered: np.ndarray


def words(chunk: Chunk) -> Words:
    """Words of ASCII letters (lower-cased), digits and non-ASCII characters; they never cross
    from one text into the next."""
    lowered = LOWER[chunk.data]
    inside = WORD_BYTE[lowered]
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    first = chunk.offsets[:-1][chunk.offsets[:-1] < len(inside)]
    before[first] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    last = chunk.offsets[1:][chunk.offsets[1:] > 0] - 1
    after[last] = False
    end = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(chunk.offsets, start, "right") - 1
    return Words(doc, start, end, span_hashes(lowered, start, end), lowered)


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """One hash for every ``length`` neighbouring hashes."""
    n = max(len(hashes) - length + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * _U(_BASE) + hashes[k : k + n]
    return mix(out)
