from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pytest
from llm.corpus import by_id, documents, table
from pyspark.sql import functions as F

from demandpanel.llm import fingerprint, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def jaccard(a: str, b: str) -> float:
    x, y = (Counter(WORD.findall(t.lower())) for t in (a, b))
    both = set(x) | set(y)
    return sum(min(x[w], y[w]) for w in both) / max(1, sum(max(x[w], y[w]) for w in both))


def edited(text: str, following: str) -> str:
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


@pytest.fixture(scope="module")
def result(spark, sf):
    return by_id(queries.op10_fingerprint(spark, sf))


def test_edited_texts(result, sf):
    docs = sorted(table(sf, "documents"), key=lambda d: -d["doc_id"])
    assert len(result) == len(docs)
    for d, following in zip(docs, docs[1:] + docs[:1], strict=True):
        row = result[d["doc_id"]]
        assert row["n_chars"] == len(d["text"])
        changed = edited(d["text"], following["text"])
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()


def test_likeness_estimates_generalised_jaccard(result, sf):
    docs = sorted(table(sf, "documents"), key=lambda d: -d["doc_id"])
    errors, spread = [], []
    for d, following in zip(docs, docs[1:] + docs[:1], strict=True):
        row = result[d["doc_id"]]
        pairs = [
            (row["near_edited"], jaccard(d["text"], edited(d["text"], following["text"]))),
            (row["near_next"], jaccard(d["text"], following["text"])),
        ]
        for got, true in pairs:
            errors.append(got - true)
            spread.append(true * (1 - true) / fingerprint.SAMPLES)
    n = len(errors)
    # Errors of different documents hang together: common words draw the same numbers in all.
    assert abs(sum(errors) / n) < math.sqrt(sum(spread) / n) / 4
    assert 0.8 < sum(e * e for e in errors) / sum(spread) < 1.2


def test_equal_texts_have_equal_fingerprints(result, sf):
    seen = {}
    for d in table(sf, "documents"):
        mark = result[d["doc_id"]]["fingerprint"]
        assert seen.setdefault(d["text"], mark) == mark
    assert len(seen) < len(result)


def test_weights_are_counts(spark):
    texts = spark.createDataFrame(
        [("a b a c", "a c c d"), ("", "a"), (None, "!"), ("x " * 40_000, "x")], "l string, r string"
    )
    out = fingerprint.weighted(texts, [F.col("l"), F.col("r")]).collect()
    counts = [sorted((t["w0"], t["w1"]) for t in r["terms"]) for r in out]
    assert counts == [
        [(0, 1), (1, 0), (1, 2), (2, 1)],
        [(0, 1), (1, 0)],
        [(0, 1), (1, 0)],
        [(40_000, 1)],
    ]


def test_cases(spark):
    texts = {5: None, 4: "", 3: "one two three", 2: "one two three", 1: "é", 0: "w " * 30_000}
    docs = documents(spark, texts).withColumn("bucket", F.lit("x")).withColumn("guest", F.lit(1))
    rows = by_id(fingerprint.compare_edited(docs))
    assert len(rows) == 6
    assert rows[3]["fingerprint"] == rows[2]["fingerprint"] and rows[3]["near_next"] == 1.0
    assert rows[5]["fingerprint"] == rows[4]["fingerprint"] and rows[5]["n_chars"] == 0
    assert rows[0]["edited_sha256"] == hashlib.sha256((texts[0][:40_000]).encode()).hexdigest()
    plain = by_id(fingerprint.fingerprints(docs))
    assert len(plain) == 6 and plain[2]["fingerprint"] == plain[3]["fingerprint"]


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = documents(spark, {1: "a b c d", 2: "e f g"})
    docs = docs.unionByName(docs).unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")))
    rows = fingerprint.compare_edited(docs).collect()
    assert len(rows) == 6
    assert len({r["fingerprint"] for r in rows}) == 2
    assert fingerprint.compare_edited(documents(spark, [])).count() == 0
    alone = fingerprint.compare_edited(documents(spark, ["only this"])).collect()
    assert [r["near_next"] for r in alone] == [1.0]


def test_buckets_cut_finely(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BOUNDS", 3)
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 2)
    texts = [f"text number {i}" for i in range(40)]
    rows = by_id(fingerprint.compare_edited(documents(spark, texts)))
    for i, text in enumerate(texts):
        changed = edited(text, texts[i - 1])
        assert rows[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
