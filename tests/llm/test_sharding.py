from __future__ import annotations

import zlib

import pytest
from compare import connect, spark_rows, sql_rows
from llm.corpus import by_id, documents, table
from pyspark.sql import functions as F

from demandpanel.llm import queries, sharding


def brute(sizes: list[tuple[int, int]], shards: int) -> dict[int, tuple[int, int]]:
    total, start, out, slots = sum(s for _, s in sizes), 0, {}, {}
    for i, size in sorted(sizes):
        shard = min(shards - 1, shards * (2 * start + size) // (2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        out[i] = (shard, slots[shard])
        start += size
    return out


def test_query_against_brute_force(spark, sf):
    docs = table(sf, "documents")
    got = by_id(queries.op7_sharding(spark, sf))
    want = brute([(d["doc_id"], len(d["text"].encode()) + 8) for d in docs], 24)
    assert {i: (r["shard"], r["slot"]) for i, r in got.items()} == want
    for d in docs:
        row = got[d["doc_id"]]
        assert row["size"] == len(d["text"].encode()) + 8
        assert row["text_crc32"] == zlib.crc32(d["text"].encode())
        assert row["law"] == "bytes" and row["grown_shard"] is None


def test_sizes_are_near_equal(spark, sf):
    rows = by_id(queries.op7_sharding(spark, sf)).values()
    total = [0] * 24
    for r in rows:
        total[r["shard"]] += r["size"]
    most = max(r["size"] for r in rows)
    assert all(abs(t - sum(total) / 24) <= most for t in total)


def test_null_empty_and_repeated_rows(spark):
    docs = documents(spark, [None, "", "é", "abc", "x" * 50_000])
    docs = docs.unionByName(docs).withColumn("shard_hint", F.lit(1))
    rows = sharding.sized(docs)
    assert sorted(r["size"] for r in rows.collect()) == sorted([8, 8, 10, 11, 50_008] * 2)
    out = sharding.balanced_shards(rows, 4, "size", ["doc_id", "text_crc32"]).collect()
    assert len(out) == 10
    for shard in {r["shard"] for r in out}:
        slots = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_empty_table_and_wrong_count(spark):
    rows = sharding.sized(documents(spark, []))
    assert sharding.balanced_shards(rows, 3, "size", ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        sharding.balanced_shards(rows, 0, "size", ["doc_id"])


def test_query_matches_sql(spark, sf):
    columns, rows = spark_rows(queries.op7_sharding(spark, sf))
    expected_columns, expected = sql_rows(connect(sf), queries.ORACLE["op7_sharding"])
    assert columns == expected_columns
    assert rows == expected and len(rows) == 1000
