"""Similarity join of texts by the Jaccard similarity of their word shingles.

MinHash signatures are cut into bands and shuffled by band hash. Texts that meet in a band are
candidates; connected candidates are brought together once, in blocks, and every pair in them is
verified on the full sets of shingles. Pairs are never written as rows: a block adds up the
links of its members and links them to a root.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.graph import components
from demandpanel.llm.textio import Chunk, chunks, mix, windows, words
from demandpanel.sources.checkpoints import ensure_checkpoint_dir, written

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
ROWS = 5
#: Members of a block: a pair of blocks is verified in one task.
BLOCK = 256
COLUMNS = 4096


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` hashes so that a pair at the threshold meets with that probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def _shingles(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes and their documents, the words' hashes and where each text's begin.

    A text of fewer words than a shingle has, but not none, is one shingle.
    """
    w = words(chunk)
    n = chunk.hi - chunk.lo
    first = np.searchsorted(w.doc, np.arange(n + 1))
    count = np.diff(first)
    h = windows(w.hash, SHINGLE)
    inside = w.doc[: len(h)] == w.doc[SHINGLE - 1 :][: len(h)]
    doc, h = w.doc[: len(h)][inside], h[inside]
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        own = [windows(w.hash[first[d] : first[d + 1]], int(count[d]))[0] for d in short]
        doc, h = np.r_[doc, short], np.r_[h, np.array(own, np.uint64)]
        order = np.argsort(doc, kind="stable")
        doc, h = doc[order], h[order]
    return doc, h, w.hash, first


def _minhash_bands(doc: np.ndarray, h: np.ndarray, n: int, bands: int, rows: int) -> np.ndarray:
    """Band hashes of ``n`` texts, zero rows for those without shingles."""
    out = np.zeros((n, bands), np.uint64)
    some = np.unique(doc)
    if not len(some):
        return out
    starts = np.searchsorted(doc, some)
    pick = np.random.default_rng(5)
    for band in range(bands):
        value = np.full(len(some), band + 1, np.uint64)
        for _ in range(rows):
            flip, times = pick.integers(0, 1 << 64, 2, dtype=np.uint64)
            low = np.minimum.reduceat((h ^ flip) * (times | np.uint64(1)), starts)
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) ^ low)
        out[some, band] = value
    return out


def signatures(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
    recall: float = RECALL, rows: int = ROWS,
) -> DataFrame:
    """``doc_id, key, bands``: a 128-bit hash of the words, null without words, and band hashes."""
    bands = bands_for(threshold, recall, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                doc, h, word, first = _shingles(chunk)
                n = chunk.hi - chunk.lo
                found = _minhash_bands(doc, h, n, bands, rows).view(np.int64)
                keys = [
                    hashlib.blake2b(word[a:b].tobytes(), digest_size=16).hexdigest()
                    if b > a
                    else None
                    for a, b in zip(first[:-1], first[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(chunk.lo, n),
                        pa.array(keys, pa.string()),
                        pa.ListArray.from_arrays(
                            np.arange(n + 1, dtype=np.int32) * bands, found.ravel()
                        ),
                    ],
                    ["doc_id", "key", "bands"],
                )

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, key string, bands array<long>")


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at ``left`` with those at ``right``."""
    out = np.zeros((len(left), len(right)), np.float32)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], column[shared]
    if not len(row):
        return out
    column = np.unique(column, return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, int(column[-1]) + 1, COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        out += part[left] @ part[right].T
    return out


def _verify(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        copies = table.column("copies").to_numpy()
        block = table.column("block").to_numpy()
        sets: list[np.ndarray] = []
        for chunk in chunks(table.column("text").combine_chunks()):
            doc, h, _, _ = _shingles(chunk)
            at = np.searchsorted(doc, np.arange(chunk.hi - chunk.lo + 1))
            sets += [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        low = block.min()
        left = np.flatnonzero(block == low)
        right = left if block.max() == low else np.flatnonzero(block != low)
        same_block = table.column("b1")[0].as_py() == table.column("b2")[0].as_py()
        if right is left and not same_block:  # the other block has no members
            return _linked(node[:0], copies[:0], node[:0])
        size = np.array([len(s) for s in sets], np.float32)
        common = _overlaps(sets, left, right)
        near = common * (1 + threshold) >= threshold * (size[left][:, None] + size[right]) - 1e-3
        near &= node[left][:, None] != node[right]
        links = np.zeros(len(sets), np.int64)
        links[left] = near @ copies[right]
        if right is not left:
            links[right] = near.T @ copies[left]
        i, j = np.nonzero(near)
        i, j = left[i], right[j]
        root = node.copy()
        while True:
            low = np.minimum(root[i], root[j])
            new = root.copy()
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
            if (new == root).all():
                break
            root = new
        some = links > 0
        return _linked(node[some], links[some], root[some])

    return run


def _linked(node, links, root) -> pa.Table:
    return pa.table(
        {
            "node": pa.array(node, pa.int64()),
            "links": pa.array(links, pa.int64()),
            "root": pa.array(root, pa.int64()),
        }
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """One row for every row of ``docs``: ``doc_id, copy_of, class_id, n_links``.

    ``copy_of`` is the least id with the same words, ``class_id`` the least id that links lead
    to, and ``n_links`` the number of other documents with a Jaccard similarity of ``threshold``
    or more, copies included. Words are those of ``textio.words``, shingles have five; a text
    of fewer is one shingle. A null, empty or wordless text is linked to none and its own
    class. Ids are integers that tell documents apart: texts under one id belong to one class,
    and a row without an id is linked only to rows of the same words. Other columns are not
    read.

    Exact copies are pre-aggregated, so a group of them costs as much as one text. Candidates of
    one class meet in pairs of blocks; the shuffled rows of a class of m different texts are
    m * m / ``BLOCK``.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    signed = signatures(docs, doc_id, text, threshold, recall).checkpoint()
    texts = (
        signed.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("node"),
            F.count(F.lit(1)).alias("copies"),
            F.first("bands").alias("bands"),
        )
        .where("node IS NOT NULL")
        .checkpoint()
    )
    # The band's number is part of its hash.
    met = texts.select("node", F.explode("bands").alias("band"))
    star = met.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n"))
    edges = met.join(star.where("n > 1").drop("n"), "band").select(
        F.col("node").alias("a"), F.col("hub").alias("b")
    )
    member = components(edges).checkpoint()
    size = member.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    member = member.join(size, "component").withColumn(
        "block", F.expr("pmod(xxhash64(node), blocks)")
    )
    source = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))
    copies = texts.groupBy("node").agg(F.sum("copies").alias("copies"))
    pairs = (
        source.join(member.join(copies, "node"), "node")
        .select(
            "*", F.expr("explode(sequence(0L, blocks - 1))").alias("other")
        )
        .select(
            "component", "node", "copies", "block", "text",
            F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"),
        )
    )
    linked = (
        pairs.groupBy("component", "b1", "b2")
        .applyInArrow(_verify(threshold), "node long, links long, root long")
        .checkpoint()
    )
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_text = (
        texts.select("key", "node", "copies")
        .join(links, "node", "left")
        .join(joined, "node", "left")
        .select(
            "key",
            F.col("node").alias("copy_of"),
            F.coalesce("component", "node").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    return signed.join(per_text, "key", "left").select(
        "doc_id",
        F.coalesce("copy_of", "doc_id").alias("copy_of"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates: that of the least id, null last.

    Rows are told apart by a number of their own, not by their ids: repeated rows are copies of
    which one stays, different texts under one id both stay, and rows without an id are compared
    like others. Null, empty and wordless texts are near none and all stay. ``docs`` is written once, so
    that the numbers hold whatever is computed again.
    """
    row = "__near_row"
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    classes = near_duplicates(rows, row, text, **how).select(F.col("doc_id").alias(row), "class_id")
    named = classes.join(rows.select(row, F.col(doc_id).alias("__near_id")), row)
    order = F.struct(F.col("__near_id").isNull().alias("lost"), "__near_id", row)
    first = named.groupBy("class_id").agg(F.min(order)[row].alias(row))
    return rows.join(first.select(row), row, "left_semi").select(*docs.columns)
