"""Repeated passages by suffix arrays over minimizer partitions.

Windows of ``WINDOW`` bytes with the same content have the same minimizer, the least hash of the
``GRAM``-byte strings in them. Neighbouring windows with one minimizer make a segment, and
segments are dealt out by minimizer, so equal windows meet. Equal segments collapse to the
first; a suffix array with common prefixes is built over those that differ, and a stack scan of
its interval tree gives the maximal repeats: groups of all occurrences that cannot be extended
to the left or right.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.textio import _BASE, _BYTE, Chunk, chunks, mix, span_hashes
from demandpanel.sources.checkpoints import ensure_checkpoint_dir

WINDOW, GRAM = 100, 16
#: Bytes of segments in one suffix array, and different segments of a minimizer beyond which
#: its windows are dealt out singly by content.
ARRAY_BYTES, SEGMENTS = 1 << 19, 2000
#: Segments that a task holds before it packs and sends them.
RECORDS = 1 << 20


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    h, step = _BYTE[data], 1
    while step < gram:  # a power of two
        h = h[:-step] * np.uint64(pow(_BASE, step, 1 << 64)) + h[step:]
        step *= 2
    return mix(h)


def _sliding_minimum(v: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        v = np.minimum(v[:-step], v[step:])
        step *= 2
    return np.minimum(v[: len(v) - (width - step)], v[width - step :])


def segments_of(chunk: Chunk, window: int = WINDOW, gram: int = GRAM):
    """Document, first byte in it, number of windows, minimizer and content hash of segments."""
    data = chunk.data
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none, none, none, none, none
    h = _grams(data, gram)
    place = np.uint64(max(len(data).bit_length(), 1))
    low = np.arange(len(h), dtype=np.uint64)
    at = _sliding_minimum((h >> place << place) | low, window - gram + 1)
    at = (at & ((np.uint64(1) << place) - np.uint64(1))).astype(np.int64)
    p = np.arange(len(at))
    doc = np.searchsorted(chunk.offsets, p, "right") - 1
    valid = p + window <= chunk.offsets[doc + 1]
    p, doc, at = p[valid], doc[valid], at[valid]
    if not len(p):
        return none, none, none, none, none
    new = np.r_[True, (np.diff(p) != 1) | (np.diff(at) != 0) | (np.diff(doc) != 0)]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(p)])
    start = p[first]
    content = span_hashes(data, start, start + count + window - 1)
    doc = doc[first]
    return doc, start - chunk.offsets[doc], count, h[at[first]].view(np.int64), content.view(np.int64)


def suffix_array(data: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order and the common prefix of each with the one before it.

    ``end`` is where the segment of each byte ends; a suffix ends with its segment, and prefixes
    of 255 bytes are told apart. Ranks of prefixes of doubled length are kept, and common
    prefixes are read off them.
    """
    n = len(data)
    left = end - np.arange(n)
    levels = [np.r_[data.astype(np.int64) + 1, 0]]
    for k in range(8):
        step, last = 1 << k, levels[-1]
        follow = np.where(left > step, last[np.minimum(np.arange(n) + step, n)], 0)
        key = last[:n] * np.int64(max(int(last.max()), 1) + 1) + follow
        _, rank = np.unique(key, return_inverse=True)
        levels.append(np.r_[rank + 1, 0])
    order = np.argsort(levels[-1][:n], kind="stable")
    a, b = order[:-1], order[1:]
    common = np.zeros(max(n - 1, 0), np.int64)
    for k in range(7, -1, -1):
        step, level = 1 << k, levels[k]
        x, y = np.minimum(a + common, n), np.minimum(b + common, n)
        both = (left[a] - common >= step) & (left[b] - common >= step)
        common += step * (both & (level[x] == level[y]))
    return order, np.r_[0, common]


def maximal_intervals(common: np.ndarray, before: np.ndarray, least: int) -> list:
    """``(first, last, depth)`` of all intervals of depth ``least`` or more whose suffixes are
    not all preceded by the same byte; ``before`` is that byte, or -1 where there is none."""
    out: list[tuple[int, int, int]] = []
    hot = np.flatnonzero(common >= least)
    if not len(hot):
        return out
    depth, mark_of = common.tolist(), before.tolist()
    for run in np.split(hot, np.flatnonzero(np.diff(hot) > 1) + 1):
        stack: list[list[int]] = []
        last = int(run[-1]) + 1
        for i in range(int(run[0]), last + 1):
            now = depth[i] if i < last else 0
            first, mark = i - 1, mark_of[i - 1]
            while stack and stack[-1][0] > now:
                d, first, seen = stack.pop()
                mark = mark if mark == seen else -1
                if mark == -1:
                    out.append((first, i - 1, d))
            if now:
                if stack and stack[-1][0] == now:
                    if stack[-1][2] != mark:
                        stack[-1][2] = -1
                else:
                    stack.append([now, first, mark])
    return out


def maximal_repeats(parts: list[bytes], least: int = WINDOW) -> Iterator[tuple[int, list]]:
    """Length and all occurrences ``(part, byte)`` of every maximal repeat among ``parts``."""
    data, end, part, at = _lined_up(parts)
    order, common = suffix_array(data, end)
    for first, last, depth in maximal_intervals(common, _before(data, at)[order], least):
        here = order[first : last + 1]
        yield depth, list(zip(part[here].tolist(), at[here].tolist(), strict=True))


def _lined_up(parts: list[bytes]):
    size = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    part = np.repeat(np.arange(len(parts)), size)
    ends = np.cumsum(size)
    return data, ends[part], part, np.arange(len(data)) - (ends - size)[part]


def _before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.where(at > 0, np.r_[0, data[:-1]].astype(np.int64) if len(data) else 0, -1)


def _later_copies(doc: np.ndarray, start: np.ndarray, parts: list[bytes], window: int):
    """Spans inside ``parts`` that repeat an earlier one: document, first byte, length.

    Parts of which no window is met twice stay out of the suffix array.
    """
    data, end, part, _ = _lined_up(parts)
    begin = np.flatnonzero(end - np.arange(len(data)) >= window)
    _, which, times = np.unique(
        span_hashes(data, begin, begin + window), return_inverse=True, return_counts=True
    )
    some = np.unique(part[begin[times[which] > 1]])
    doc, start, parts = doc[some], start[some], [parts[i] for i in some]
    data, end, part, at = _lined_up(parts)
    order, common = suffix_array(data, end)
    found = maximal_intervals(common, _before(data, at)[order], window)
    if not found:
        return np.zeros((3, 0), np.int64)
    first, last, depth = np.array(found, np.int64).T
    size = last - first + 1
    owner = np.repeat(np.arange(len(found)), size)
    begin = np.cumsum(size) - size
    here = order[np.arange(len(owner)) - begin[owner] + first[owner]]
    d, s = doc[part[here]], start[part[here]] + at[here]
    ranked = np.lexsort((s, d, owner))
    earliest = np.r_[True, np.diff(owner[ranked]) != 0]
    rest = ranked[~earliest]
    same = np.zeros(len(owner), bool)  # the very same place, cut out twice
    lead = ranked[earliest]
    same[rest] = (d[rest] == d[lead[owner[rest]]]) & (s[rest] == s[lead[owner[rest]]])
    rest = rest[~same[rest]]
    return np.stack([d[rest], s[rest], depth[owner[rest]]])


SPAN = "doc long, start long, length long"
#: Segments (or spans) packed by bucket, one binary per column, and what a bucket finds.
PACKED = "bucket int, mini binary, content binary, doc binary, start binary, size binary"
FOUND = f"{SPAN}, mini long, kinds int"
DEALT = "mini long, salt long, doc long, start long, length long, part binary"


def _frame(schema: str, *columns) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    of = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrays = [pa.array(x, of[k]) for x, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def _copies_of_first(doc: np.ndarray, start: np.ndarray, content: np.ndarray):
    """Segments that are the first of their content, and those that copy one elsewhere."""
    order = np.lexsort((start, doc, content))
    new = np.r_[True, np.diff(content[order]) != 0]
    lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    moved = (doc[order] != doc[lead]) | (start[order] != start[lead])
    return order[new], order[moved]


def _joined(doc: np.ndarray, start: np.ndarray, length: np.ndarray):
    """Spans of one document that touch or overlap, as one."""
    if not len(doc):
        return doc, start, length
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], (start + length)[order]
    owner = np.cumsum(np.r_[0, np.diff(doc) != 0])
    reach = np.maximum.accumulate(end + owner * (int(end.max()) + 1)) - owner * (int(end.max()) + 1)
    new = np.r_[True, (np.diff(doc) != 0) | (start[1:] > reach[:-1])]
    first = np.flatnonzero(new)
    return doc[first], start[first], reach[np.r_[first[1:], len(doc)] - 1] - start[first]


def _packed(mini, content, doc, start, count, parts: int, window: int) -> pa.RecordBatch:
    """The first segment of each content by the bucket of its minimizer, and spans of the others
    by the bucket of their document: copies met here are not sent any further."""
    first, copy = _copies_of_first(doc, start, content)
    spans = _joined(doc[copy], start[copy], count[copy] + window - 1)
    rows: list[tuple] = []
    for bucket, ids, hashes, of, at, size in (
        ((mini[first] >> 20) % parts, mini[first] & 0xFFFFFFFF, content[first], doc[first], start[first], count[first]),
        (spans[0] % parts, None, None, *spans),
    ):
        order = np.lexsort((at, of, bucket))
        cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else []
        for some in np.split(order, cuts[1:]) if len(order) else []:
            rows.append(
                (
                    int(bucket[some[0]]),
                    b"" if ids is None else ids[some].astype(np.uint32).tobytes(),
                    b"" if hashes is None else hashes[some].tobytes(),
                    np.diff(of[some], prepend=0).tobytes(),  # near zero: compresses well
                    at[some].astype(np.uint32).tobytes(),
                    size[some].astype(np.uint32).tobytes(),
                )
            )
    return _frame(PACKED, *([r[k] for r in rows] for k in range(6)))


def _dealt(rows: list[tuple], earliest: dict[bytes, tuple], copies: list) -> pa.RecordBatch:
    """Rows ``DEALT``: segments, single windows (their salts begin at 1), and spans."""
    for one, (doc, start, mini, salts) in earliest.items():
        salt = 1 + int.from_bytes(hashlib.blake2b(one, digest_size=8).digest()) % salts
        rows.append((mini, salt, doc, start, len(one), one))
    if copies:
        for doc, start, length in zip(*(x.tolist() for x in _joined(*np.array(copies).T)), strict=True):
            rows.append((0, -1 - doc % 1024, doc, start, length, None))
    return _frame(DEALT, *([r[k] for r in rows] for k in range(6)))


def cut_segments(docs: DataFrame, parts: int, window: int, gram: int) -> DataFrame:
    """Segments of ``docs (doc, text)`` as rows ``PACKED``; no task holds more than about
    ``RECORDS`` of them at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            ids = batch.column("doc").to_numpy()
            for chunk in chunks(batch.column("text")):
                row, start, count, mini, content = segments_of(chunk, window, gram)
                held.append((mini, content, ids[chunk.lo + row], start, count))
                if sum(len(h[0]) for h in held) >= RECORDS:
                    yield _packed(*map(np.concatenate, zip(*held, strict=True)), parts, window)
                    held = []
        if held:
            yield _packed(*map(np.concatenate, zip(*held, strict=True)), parts, window)

    return docs.mapInArrow(run, PACKED)


def _matched(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Of one bucket: spans of copies (no ``kinds``), and the first of every content whose
    minimizer has several."""
    held: list[list[np.ndarray]] = []
    spans: list[list[np.ndarray]] = []
    for batch in batches:
        for ids, hashes, of, at, size in zip(
            *(batch.column(c).to_pylist() for c in batch.schema.names[1:]), strict=True
        ):
            place = [
                np.cumsum(np.frombuffer(of, np.int64)),
                *(np.frombuffer(x, np.uint32).astype(np.int64) for x in (at, size)),
            ]
            if ids:
                held.append([np.frombuffer(ids, np.uint32), np.frombuffer(hashes, np.int64), *place])
            else:
                spans.append(place)
    if held:
        mini, content, doc, start, count = map(np.concatenate, zip(*held, strict=True))
        held = []
        first, copy = _copies_of_first(doc, start, content)
        spans.append([doc[copy], start[copy], count[copy] + window - 1])
        _, which, kinds = np.unique(mini[first], return_inverse=True, return_counts=True)
        kinds = kinds[which]
        first, kinds = first[kinds > 1], kinds[kinds > 1]
        yield _frame(FOUND, doc[first], start[first], count[first], mini[first].astype(np.int64), kinds)
    if spans:
        doc, start, length = _joined(*map(np.concatenate, zip(*spans, strict=True)))
        none = np.zeros(len(doc), np.int64)
        yield _frame(FOUND, doc, start, length, none, none)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc, start, length``: spans of the texts of ``docs (doc, text)`` that a string of
    ``window`` bytes or more covers which also starts earlier, in a smaller document or before
    it in the same. Spans may overlap; together they cover all such bytes. Rows without ``doc``
    are not compared.

    Segments travel as packed records of some 20 bytes, after each task has collapsed equal
    ones. What the buckets find is written to the folder of checkpoints, as two plans read it.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = cut_segments(docs.where("doc IS NOT NULL"), parts, window, gram)
    found = packed.repartitionById(parts, F.col("bucket")).mapInArrow(
        lambda batches: _matched(batches, window), FOUND
    )
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/repeats-{uuid.uuid4().hex}"
    found.write.parquet(path)
    found = spark.read.schema(FOUND).parquet(path)
    copies = found.where("kinds = 0").select("doc", "start", "length")
    wanted = found.where("kinds > 0").groupBy("doc").agg(
        F.collect_list(F.struct("mini", "kinds", "start", "length")).alias("wanted")
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of segments; windows one by one, with a salt of their own, if there are
        very many different segments. Of equal windows in a batch only the earliest is dealt;
        the others are spans already, without bytes."""
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            rows: list[tuple] = []
            earliest: dict[bytes, tuple] = {}
            copies: list[tuple[int, int, int]] = []
            for i, (doc, segments) in enumerate(
                zip(batch.column("doc").to_pylist(), batch.column("wanted").to_pylist(), strict=True)
            ):
                if not segments or not texts[i].is_valid:
                    continue
                data = texts[i].as_buffer()
                for s in segments:
                    start, count = s["start"], s["length"]
                    part = data[start : start + count + window - 1].to_pybytes()
                    if s["kinds"] <= SEGMENTS:
                        rows.append((s["mini"], 0, doc, start, len(part), part))
                        continue
                    salts = s["kinds"] * (window - gram + 1) // SEGMENTS + 1
                    for k in range(len(part) - window + 1):
                        one, here = part[k : k + window], (doc, start + k, s["mini"], salts)
                        met = earliest.setdefault(one, here)
                        if met[:2] != here[:2]:
                            earliest[one], later = (here, met) if here < met else (met, here)
                            copies.append((*later[:2], window))
                if len(rows) + len(earliest) >= 20_000:
                    yield _dealt(rows, earliest, copies)
                    rows, earliest, copies = [], {}, []
            yield _dealt(rows, earliest, copies)

    # A left join, though only documents with segments matter: so the texts are shuffled once,
    # for this join and for the one with the spans.
    dealt = docs.join(wanted, "doc", "left").select("doc", "text", "wanted").mapInArrow(deal, DEALT)
    dealt = dealt.repartition(parts, "mini", "salt").sortWithinPartitions("mini", "salt", "doc", "start")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Suffix arrays over as many whole minimizers as ``ARRAY_BYTES`` hold. Windows dealt
        singly come earliest first, so each that was met before is a copy."""
        doc, start, held, size, last = [], [], [], 0, None
        met: dict[bytes, tuple[int, int]] = {}
        for batch in batches:
            spans: list[tuple[int, int, int]] = []
            columns = (batch.column(c).to_pylist() for c in batch.schema.names)
            for mini, salt, d, s, length, part in zip(*columns, strict=True):
                if part is None:
                    spans.append((d, s, length))
                    continue
                if (mini, salt) != last:
                    met = {}
                    if size >= ARRAY_BYTES:
                        found = _later_copies(np.array(doc), np.array(start), held, window)
                        yield _frame(SPAN, *_joined(*found))
                        doc, start, held, size = [], [], [], 0
                last = (mini, salt)
                if salt:
                    if met.setdefault(part, (d, s)) != (d, s):
                        spans.append((d, s, length))
                    continue
                doc.append(d)
                start.append(s)
                held.append(part)
                size += len(part)
            if spans:
                yield _frame(SPAN, *_joined(*np.array(spans, np.int64).T))
        if held:
            found = _later_copies(np.array(doc), np.array(start), held, window)
            yield _frame(SPAN, *_joined(*found))

    return dealt.mapInArrow(scan, SPAN).unionByName(copies)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: every whole text without the bytes that any string of
    ``window`` bytes covers which also starts earlier, judged on the input.

    Texts are UTF-8 bytes, null counts as empty, and strings never cross documents. ``spans``
    are the maximal removed runs ``struct<start, length>``, and ``kept`` the remaining bytes.
    Ids are integers; rows that repeat an id and its text each get the result of one such row,
    other texts under one id are compared by position only, and a row without an id is left as
    it is and not compared. Other columns are not read. ``gram`` is a power of two below
    ``window``.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    spans = repeated_spans(source, window, gram)
    spans = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "length")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, found in zip(
                batch.column("text").cast(pa.binary()).to_pylist(),
                batch.column("found").to_pylist(),
                strict=True,
            ):
                data = data or b""
                gone = np.zeros(len(data) + 1, np.int64)
                for span in found or ():
                    gone[span["start"]] += 1
                    gone[span["start"] + span["length"]] -= 1
                away = np.cumsum(gone[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.r_[False, away, False]))
                runs = [
                    {"start": int(a), "length": int(b - a)}
                    for a, b in zip(edge[::2], edge[1::2], strict=True)
                ]
                kept = np.frombuffer(data, np.uint8)[~away].tobytes()
                rows.append((len(data), runs, kept))
            run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    *[
                        pa.array([r[k] for r in rows], kind)
                        for k, kind in enumerate((pa.int64(), run, pa.binary()))
                    ],
                ],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    joined = source.join(spans, "doc", "left").select("doc", "text", "found")
    return joined.mapInArrow(
        cut,
        "doc_id long, n_bytes long, spans array<struct<start:long,length:long>>, kept binary",
    )
