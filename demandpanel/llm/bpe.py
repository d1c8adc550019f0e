"""Byte-level BPE by tree reduction.

A text is cut into halves down to leaves, leaves are encoded, and neighbours are joined by
re-encoding a window over their seam that grows until what lies outside cannot change. The
join is associative, so the tree may have any shape. Two such trees are nested:

* Over a text, whose pattern matches are encoded separately. A match of the left half stands if
  the pattern looked at no character beyond that half to make it: the pattern looks at most
  two characters past a match. A match of the right half stands from the first of its
  boundaries on that the re-matched window also has, since matching from a place depends only
  on what follows.
* Over a long match. Tokens left and right of a window stand if the tokens at both its edges
  are those into which the two of them together are encoded: merges by rank never cross a
  boundary whose two neighbours would not merge across it by themselves.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LOOKAHEAD = 2
LEAF_CHARS = 8192
LEAF_BYTES = 64
LEAF_TOKENS = 1 << 14
SHORT_BYTES = 24
SLICE_ROWS = 256
CACHE_PIECES = 1 << 17
CACHE_PIECE_CHARS = 32


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Pieces(dict):
    """Token ids by match of the pattern, filled when asked. Of the last two generations of
    ``CACHE_PIECES`` short matches none is forgotten."""

    def __init__(self, encode: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, text: str) -> tuple[int, ...]:
        if (ids := self.old.get(text)) is None:
            ids = self.encode(text)
        if len(text) <= CACHE_PIECE_CHARS:
            if len(self) >= CACHE_PIECES:
                self.old = dict(self)
                self.clear()
            self[text] = ids
        return ids


class Codec:
    """Encode and decode with a table of ranks and a pattern that splits texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        by_rank = {rank: token for token, rank in ranks.items()}
        self.tokens = pa.array(
            [by_rank.get(k) for k in range(max(by_rank, default=-1) + 1)], pa.large_binary()
        )
        self.match = regex.compile(pattern).findall
        self.cache = Pieces(self.piece)

    def merge(self, data: bytes) -> list[bytes]:
        """Merge neighbours by lowest rank, leftmost first, until no pair has a rank."""
        if len(data) > SHORT_BYTES:
            return self._merge_by_heap(data)
        get, none = self.ranks.get, len(self.tokens)
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pairs and (low := min(pairs)) < none:
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        return parts

    def _merge_by_heap(self, data: bytes) -> list[bytes]:
        n, rank = len(data), self.ranks.get
        end = list(range(1, n + 1))  # of the part that begins here; 0 once swallowed
        left = list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                left[stop] = i
                if (r := rank(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (before := left[i]) >= 0 and (r := rank(data[before:stop])) is not None:
                heapq.heappush(heap, (r, before, stop))
        return [data[i : end[i]] for i in range(n) if end[i]]

    def apart(self, a: bytes, b: bytes) -> bool:
        """Whether the two tokens stay as they are when they stand side by side."""
        return self.merge(a + b) == [a, b]

    def join_tokens(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        width = 1
        while True:
            i, j = max(len(left) - width, 0), min(width, len(right))
            seam = self.merge(b"".join(left[i:] + right[:j]))
            if (not i or self.apart(left[i - 1], seam[0])) and (
                j == len(right) or self.apart(seam[-1], right[j])
            ):
                return left[:i] + seam + right[j:]
            width *= 2

    def split_bytes(self, data: bytes) -> list[bytes]:
        """The tokens of one match of the pattern."""
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join_tokens(self.split_bytes(data[:half]), self.split_bytes(data[half:]))

    def piece(self, text: str) -> tuple[int, ...]:
        """Token ids of one match of the pattern."""
        data = text.encode()
        tokens = [data] if data in self.ranks else self.split_bytes(data)
        return tuple(map(self.ranks.__getitem__, tokens))

    def join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        """Join the matches of two neighbouring texts; the left list is used up."""
        seam, after = "", 0
        while left and after < LOOKAHEAD:
            after += len(left[-1])
            seam = left.pop() + seam
        width = 2
        while True:
            part = right[:width]
            text = seam + "".join(part)
            whole = width >= len(right)
            bounds, at = {len(seam): 0}, len(seam)
            for k, piece in enumerate(part, 1):
                at += len(piece)
                bounds[at] = k
            found, at = [], 0
            for piece in self.match(text):
                at += len(piece)
                if not whole and at + LOOKAHEAD > len(text):
                    break
                found.append(piece)
                if at in bounds:
                    left += found
                    left += right[bounds[at] :]
                    return left
            if whole:  # only if both halves are empty
                return left + found
            width *= 2

    def pieces(self, text: str) -> list[str]:
        if len(text) <= LEAF_CHARS:
            return self.match(text)
        half = len(text) // 2
        return self.join_pieces(self.pieces(text[:half]), self.pieces(text[half:]))

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of a whole text; none for null or an empty text."""
        codes = map(self.cache.__getitem__, self.pieces(text) if text else ())
        return np.fromiter(chain.from_iterable(codes), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, halves put together up the tree."""
        if len(ids) <= LEAF_TOKENS:
            if not len(ids):
                return b""
            found = self.tokens.take(pa.array(ids))
            if found.null_count:
                raise ValueError("no token has one of these ids")
            _, starts, data = found.buffers()
            stop = np.frombuffer(starts, np.int64)[len(ids)]
            return data[: int(stop)].to_pybytes() if stop else b""
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def broadcast_ranks(spark: SparkSession, path: str) -> Broadcast:
    """Ranks for :func:`encode` and :func:`decode`; a vocabulary does not grow with the data."""
    return spark.sparkContext.broadcast(read_ranks(path))


_codecs: dict[tuple[int, str], Codec] = {}  # of this worker process


def _codec(ranks: Broadcast, pattern: str) -> Codec:
    """The codec of this worker process, with what it has cached so far."""
    key = (id(ranks.value), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks.value, pattern)
    return _codecs[key]


def _in_slices(batches: Iterator[pa.RecordBatch], names: list[str], column: str, make):
    """Few rows at a time: long texts make many tokens."""
    for whole in batches:
        for lo in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(lo, SLICE_ROWS)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], make(batch)], [*names, column]
            )


def encode(
    docs: DataFrame, ranks: Broadcast, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """Add the token ids of every whole text; null and empty texts have none.

    All other columns and repeated rows stay as they are; a column named like ``ids`` is
    replaced. No rows move between partitions.
    """
    keep = [f for f in docs.schema.fields if f.name != ids]
    kind = T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)

        def make(batch: pa.RecordBatch) -> pa.Array:
            found = [codec.encode(x) for x in batch.column(text).to_pylist()]
            starts = np.cumsum([0, *map(len, found)], dtype=np.int32)
            return pa.ListArray.from_arrays(starts, np.concatenate(found))

        return _in_slices(batches, names, ids, make)

    return docs.mapInArrow(run, T.StructType([*keep, kind]))


def round_trip(
    docs: DataFrame, ranks: Broadcast, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """Add the token ids of every whole text, and replace the text by the bytes the ids stand for.

    One pass, so a task needs one Python worker and the ids travel once. Null and empty texts
    have no ids and no bytes; a column named like ``ids`` is replaced. Bytes are not yet a string.
    """
    keep = [f for f in docs.schema.fields if f.name not in (ids, text)]
    names = [f.name for f in keep]
    both = [
        T.StructField(ids, T.ArrayType(T.IntegerType(), False), False),
        T.StructField(text, T.BinaryType(), False),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(lo, SLICE_ROWS)
                found = [codec.encode(x) for x in batch.column(text).to_pylist()]
                starts = np.cumsum([0, *map(len, found)], dtype=np.int32)
                tokens = pa.ListArray.from_arrays(starts, np.concatenate(found))
                decoded = pa.array(map(codec.decode, found), pa.binary())
                columns = [*[batch.column(n) for n in names], tokens, decoded]
                yield pa.RecordBatch.from_arrays(columns, [*names, ids, text])

    return docs.mapInArrow(run, T.StructType([*keep, *both]))


def decode(
    docs: DataFrame, ranks: Broadcast, pattern: str, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """Add the bytes that the ids stand for; null ids give no bytes, unknown ids an error."""
    keep = [f for f in docs.schema.fields if f.name != decoded]
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)

        def make(batch: pa.RecordBatch) -> pa.Array:
            column = batch.column(ids)
            starts = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(column), 0))]
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            found = [codec.decode(flat[a:b]) for a, b in pairwise(starts)]
            return pa.array(found, pa.binary())

        return _in_slices(batches, names, decoded, make)

    return docs.mapInArrow(
        run, T.StructType([*keep, T.StructField(decoded, T.BinaryType(), False)])
    )
