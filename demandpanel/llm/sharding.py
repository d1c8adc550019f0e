"""Contiguous shards of equal byte size.

Every partition of the ordered rows is summed, the totals (one row a partition) are added up
to global prefix sums, and the resulting line of bytes is cut at equal targets. Only ids and
sizes are shuffled, texts never are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.sources.checkpoints import ensure_checkpoint_dir

PART, START, ROW, TOTAL, FIRST = (f"__shard_{x}" for x in ("part", "start", "row", "total", "first"))


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32``: UTF-8 bytes of the text plus 8; null counts as empty."""
    data = F.encode(F.coalesce(docs[text], F.lit("")), "UTF-8")
    return docs.select(
        docs[doc_id].alias("doc_id"),
        (F.octet_length(data) + F.lit(8)).cast("long").alias("size"),
        F.crc32(data).cast("long").alias("text_crc32"),
    )


def balanced_shards(rows: DataFrame, shards: int, size: str, order: list[str]) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Rows are put in a line by ``order``, and a row belongs to the shard in whose equal part of
    all bytes its middle byte lies. So shards are contiguous, and the size of each differs from
    the target by at most one row. Rows equal in all of ``order`` are interchangeable; nulls
    come first; a null size counts as 0; an empty table gives an empty one. Fewer rows than
    shards, or a row larger than a target, leave some shards empty. ``order`` should name all
    columns that distinguish rows, so that a recomputed task finds the same line.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    ensure_checkpoint_dir(rows.sparkSession)
    size_of = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long")
    # The checkpoint fixes which rows a partition holds: totals and rows must agree.
    line = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(PART, F.spark_partition_id())
        .checkpoint()
    )
    totals = line.groupBy(PART).agg(
        F.sum(size_of).alias("__shard_bytes"), F.count(F.lit(1)).alias("__shard_rows")
    )
    # One row a partition: small enough for one task and for a broadcast at any input size.
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        PART,
        F.coalesce(F.sum("__shard_bytes").over(before), F.lit(0)).alias("__shard_bytes_before"),
        F.coalesce(F.sum("__shard_rows").over(before), F.lit(0)).alias("__shard_rows_before"),
        F.sum("__shard_bytes").over(Window.partitionBy()).alias(TOTAL),
    )
    here = Window.partitionBy(PART).orderBy(*order)
    placed = line.join(F.broadcast(offsets), PART).select(
        *[line[c] for c in rows.columns],
        (F.sum(size_of).over(here.rowsBetween(Window.unboundedPreceding, 0))
         - size_of + F.col("__shard_bytes_before")).alias(START),
        (F.row_number().over(here) - 1 + F.col("__shard_rows_before")).alias(ROW),
        TOTAL,
    )
    middle = F.col(START) * 2 + size_of
    # Decimal arithmetic: shards * bytes passes 2**63 at some exabytes.
    cut = F.floor(middle.cast("decimal(30,0)") * shards / (F.greatest(F.col(TOTAL), F.lit(1)) * 2))
    placed = placed.withColumn("shard", F.least(cut, F.lit(shards - 1)).cast("int"))
    first = placed.groupBy("shard").agg(F.min(ROW).alias(FIRST))
    return placed.join(F.broadcast(first), "shard").select(
        *rows.columns, "shard", (F.col(ROW) - F.col(FIRST)).cast("long").alias("slot")
    )
