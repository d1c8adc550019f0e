"""Remove benchmark passages from training texts.

Every benchmark item is cut into windows of ``width`` words (an item of fewer words is one
window), the windows' hashes are broadcast, and each training text is scanned once with
vectorised window hashes. A hash that hits is verified on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.textio import chunks, windows, words
from demandpanel.sources.checkpoints import ensure_checkpoint_dir

WIDTH = 13
#: Benchmark text in one broadcast, which is about four times its size; a larger benchmark is scanned for in
#: several blocks.
BROADCAST_BYTES = 8 << 20
FILTER_BITS = 20

STATE = "__decon_items array<string>, __decon_runs array<struct<lo:int,hi:int>>"


class Windows:
    """Windows of benchmark items by length: sorted hashes to scan for, and where each stands in the
    items' words, which are kept once, a space after each, to verify hits on.

    Some 30 bytes a word, and ``2 ** FILTER_BITS`` for each length of window.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], width: int = WIDTH):
        self.ids = [item_id for item_id, _ in items]
        held, sizes, owners, found = [], [], [], {}
        n_words = 0
        for chunk in chunks(pa.array([(t or "").encode() for _, t in items], pa.large_binary())):
            w = words(chunk)
            size = w.end - w.start
            owner = np.repeat(np.arange(len(size)), size)  # the word of each of their bytes
            within = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            spaced = np.full(len(owner) + len(size), 32, np.uint8)
            spaced[np.arange(len(owner)) + owner] = w.lowered[w.start[owner] + within]
            held.append(spaced)
            sizes.append(size + 1)
            owners.append((w.doc + chunk.lo).astype(np.int32))
            first = np.searchsorted(w.doc, np.arange(chunk.hi - chunk.lo + 1))
            count = np.diff(first)
            for n in np.unique(np.minimum(count[count > 0], width)).tolist():
                h = windows(w.hash, n)
                at = np.flatnonzero(w.doc[: len(h)] == w.doc[n - 1 :][: len(h)])
                if n < width:  # items of just so many words
                    at = at[count[w.doc[at]] == n]
                found.setdefault(n, []).append((h[at], at + n_words))
            n_words += len(size)
        self.text = np.concatenate([*held, np.zeros(0, np.uint8)]).tobytes()
        self.start = np.cumsum(np.r_[0, *sizes]).astype(np.int64)
        self.owner = np.concatenate([*owners, np.zeros(0, np.int32)])
        self.sets = {}
        for n, parts in sorted(found.items()):
            h, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            quick = np.zeros(1 << FILTER_BITS, bool)
            quick[h >> np.uint64(64 - FILTER_BITS)] = True
            self.sets[n] = (h[order], at[order].astype(np.int32 if n_words < 1 << 31 else np.int64), quick)

    def met(self, n: int, h: np.uint64, key: bytes) -> set[str | None] | None:
        """Items with a window of these ``n`` words, which hash to ``h``; None where there are none."""
        known, at, _ = self.sets[n]
        lo, hi = np.searchsorted(known, h), np.searchsorted(known, h, "right")
        out = set()
        for place in at[lo:hi].tolist():
            if self.text[self.start[place] : self.start[place + n] - 1] == key:
                out.add(self.ids[self.owner[place]])
        return out or None

    def scan(self, texts: pa.Array) -> Iterator[tuple[int, list, list, list[str]]]:
        """For each text: number of words, hit runs of words, of bytes, and items met."""
        for chunk in chunks(texts):
            w = words(chunk)
            first = np.searchsorted(w.doc, np.arange(chunk.hi - chunk.lo + 1))
            hits: dict[int, list[tuple[int, int]]] = {}
            items: dict[int, set[str]] = {}
            for n, (known, _, quick) in self.sets.items():
                h = windows(w.hash, n)
                at = np.flatnonzero(quick[h >> np.uint64(64 - FILTER_BITS)])
                at = at[w.doc[at] == w.doc[at + n - 1]]
                place = np.minimum(np.searchsorted(known, h[at]), len(known) - 1)
                for i in at[known[place] == h[at]].tolist():
                    key = b" ".join(
                        w.lowered[a:b].tobytes()
                        for a, b in zip(w.start[i : i + n], w.end[i : i + n], strict=True)
                    )
                    if (found := self.met(n, h[i], key)) is not None:
                        doc = int(w.doc[i])
                        hits.setdefault(doc, []).append((i, i + n))
                        items.setdefault(doc, set()).update(found - {None})
            for doc in range(chunk.hi - chunk.lo):
                runs = merged(hits.get(doc, []))
                spans = [
                    (int(w.start[a] - chunk.offsets[doc]), int(w.end[b - 1] - chunk.offsets[doc]))
                    for a, b in runs
                ]
                base = int(first[doc])
                yield (
                    int(first[doc + 1]) - base,
                    [(a - base, b - base) for a, b in runs],
                    spans,
                    sorted(items.get(doc, ())),
                )


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint runs that cover the same places; runs that touch become one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list]:
    """The items in blocks of bounded size; one item longer than that makes a longer block."""
    items = benchmark.select(
        benchmark[item_id].cast("string").alias("item"), benchmark[text].alias("text")
    ).dropDuplicates()
    total = items.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = int(total) // limit + 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for k in range(n):
        yield [(r["item"], r["text"]) for r in items.where(block == k).collect()]


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    block_bytes: int = BROADCAST_BYTES,
    column: str = "contamination",
) -> DataFrame:
    """Add ``column``: ``struct<n_words, items, words, bytes>`` of the benchmark in each text.

    ``items`` holds the ids met, as sorted strings; ``words`` and ``bytes`` hold the runs of
    words and of UTF-8 bytes inside any occurrence of a window (end exclusive). Words are those
    of ``textio.words``. A null or empty text has no words; benchmark items without words are
    never met; an item without id marks words but is not listed. All other columns and
    repeated rows stay; an existing ``column`` is replaced. Rows do not move. A benchmark beyond
    ``block_bytes`` is broadcast and scanned for in blocks, with a checkpoint between them.
    """
    spark = docs.sparkSession
    kind = (
        "struct<n_words:bigint,items:array<string>,"
        "words:array<struct<lo:bigint,hi:bigint>>,bytes:array<struct<lo:bigint,hi:bigint>>>"
    )
    keep = [c for c in docs.columns if c != column]
    schema = docs.limit(0).select(*keep, F.lit(None).cast(kind).alias(column)).schema

    def scan_for(known):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                old = batch.column(column).to_pylist() if column in batch.schema.names else None
                rows = []
                for i, (n, runs, spans, items) in enumerate(known.value.scan(batch.column(text))):
                    if old is not None:
                        seen = old[i]
                        items = sorted({*items, *seen["items"]})
                        runs = merged([*runs, *((r["lo"], r["hi"]) for r in seen["words"])])
                        spans = merged([*spans, *((r["lo"], r["hi"]) for r in seen["bytes"])])
                    rows.append(
                        {
                            "n_words": n,
                            "items": items,
                            "words": [{"lo": a, "hi": b} for a, b in runs],
                            "bytes": [{"lo": a, "hi": b} for a, b in spans],
                        }
                    )
                span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
                found = pa.array(
                    rows,
                    pa.struct(
                        [
                            ("n_words", pa.int64()),
                            ("items", pa.list_(pa.string())),
                            ("words", span),
                            ("bytes", span),
                        ]
                    ),
                )
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep], found], [*keep, column]
                )

        return run

    out = docs.select(*keep)
    for k, items in enumerate(_blocks(benchmark, item_id, item_text, block_bytes)):
        if k:
            ensure_checkpoint_dir(spark)
            out = out.checkpoint()
        known = spark.sparkContext.broadcast(Windows(items, width))
        out = out.mapInArrow(scan_for(known), schema)
    return out


def n_hit(column: str = "contamination"):
    """Number of hit words."""
    return F.aggregate(
        F.col(column)["words"], F.lit(0).cast("bigint"), lambda n, r: n + r["hi"] - r["lo"]
    )


def contaminated(column: str = "contamination", share: float = 0.05):
    """Whether any word is hit, and hit words are at least ``share`` of all words."""
    return (n_hit(column) > 0) & (n_hit(column) >= F.col(column)["n_words"] * F.lit(share))


def without_documents(docs: DataFrame, column: str = "contamination", **how) -> DataFrame:
    """Drop contaminated documents and the column of hits."""
    return docs.where(~contaminated(column, **how)).drop(column)


def without_spans(docs: DataFrame, text: str = "text", column: str = "contamination") -> DataFrame:
    """Cut the hit bytes out of the texts and drop the column of hits."""
    data = F.encode(F.col(text), "UTF-8")
    runs = F.col(column)["bytes"]
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(runs, lambda r: r["hi"]))
    ends = F.concat(F.transform(runs, lambda r: r["lo"]), F.array(F.octet_length(data).cast("bigint")))
    kept = F.zip_with(
        starts, ends, lambda a, b: F.substring(data, (a + 1).cast("int"), (b - a).cast("int"))
    )
    joined = F.decode(F.unhex(F.array_join(F.transform(kept, F.hex), "")), "UTF-8")
    return docs.withColumn(text, F.when(F.size(runs) > 0, joined).otherwise(F.col(text))).drop(column)
