from __future__ import annotations

import numpy as np
from llm.corpus import by_id, documents, table

from demandpanel.llm import quality, queries


def test_labels_are_met_without_having_been_seen(spark, sf):
    got = by_id(queries.op6_quality(spark, sf))
    assert len(got) == len(table(sf, "documents"))
    marks = [(r["quality"], got[r["doc_id"]]["accepted"]) for r in table(sf, "labels")]
    good = [a for q, a in marks if q]
    bad = [a for q, a in marks if not q]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.15 * len(bad)


def test_expectation_maximisation_finds_accuracies():
    pick = np.random.default_rng(2)
    truth = pick.random(40_000) < 0.8
    right = [0.95, 0.9, 0.8, 0.7, 0.6]
    votes = np.stack([np.where(pick.random(len(truth)) < p, truth, ~truth) for p in right], 1)
    votes = np.where(pick.random(votes.shape) < 0.2, -1, votes).astype(np.int64)
    patterns, back, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = quality.fit_labels(patterns, n.astype(float), rounds=300)
    assert abs(model.good - 0.8) < 0.03
    for k, p in enumerate(right):
        cast = model.table[k][:, 1:] / model.table[k][:, 1:].sum(1, keepdims=True)
        assert abs(cast[0, 0] - p) < 0.05 and abs(cast[1, 1] - p) < 0.03
    assert (((model.posterior(patterns) > 0.5)[back.ravel()]) == truth).mean() > 0.95


def brute(text: str) -> dict:
    import re

    w = [(m.group().lower(), m.end()) for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", text.encode())]
    data, n = text.encode(), max(len(w), 1)
    letters = max(sum(chr(b).isalpha() and b < 128 for b in data), 1)
    follow = [data[e] if e < len(data) else 32 for _, e in w]
    return {
        "symbols": sum(33 <= b < 127 and not chr(b).isalnum() for b in data) / n,
        "capitals": sum(65 <= b <= 90 for b in data) / letters,
        "repeats": sum(a == b for (a, _), (b, _) in zip(w, w[1:], strict=False)) / n,
        "sameness": 1 - len({x for x, _ in w}) / n,
        "bars": data.count(b"|") / n,
        "unended": 1 - sum(b == 46 for b in follow) / n,
        "signed": sum(b < 128 and b not in b"\t\n\r .,;:'\"()-" for b in follow) / n,
    }


def test_statistics_against_brute_force(sf):
    import pyarrow as pa

    texts = [d["text"] for d in table(sf, "documents")][:60] + [None, "", "Ünï x x| X", "!!", "a"]
    for chunk in quality.chunks(pa.array(texts)):
        stats, _ = quality.statistics(chunk)
        for row, text in zip(stats, texts[chunk.lo : chunk.hi], strict=True):
            np.testing.assert_allclose(row, list(brute(text or "").values()))


def test_cases(spark, sf):
    model = quality.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    clean = "The rain fell on the old town, and nobody went out. We stayed at home. " * 3
    texts = [None, "", "!!!", clean, clean, "THE!! RAIN!! FELL!! ON!! " * 40, clean * 400]
    docs = documents(spark, texts).selectExpr("*", "'s' AS score", "1 AS accepted")
    rows = by_id(quality.classify(docs, model))
    assert [rows[i]["accepted"] for i in range(7)] == [False, False, False, True, True, False, True]
    assert rows[3] == {**rows[4], "doc_id": 3}
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 6]


def test_empty_table(spark):
    none = documents(spark, [])
    model = quality.fit(none)
    assert quality.classify(none, model).count() == 0


def test_labels_decide_without_a_sample(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 0)
    got = quality.classify(docs, quality.fit(docs)).collect()
    assert all(r["accepted"] == (r["posterior"] >= 0.5) for r in got if r["score"])
    assert {r["accepted"] for r in got} == {True, False}
