from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.corpus import table

from demandpanel.llm import queries, whiten

SCHEMA = "vec_id long, embedding array<float>"


def grid(v) -> tuple[int, ...]:
    return tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v)


def brute(rows: list[tuple], weights: str = "one", k: int = 16):
    """Per row (id, grid vector): n, deviation, whitened up to the sign, explained."""
    kept = [(i, grid(v)) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    copies = Counter(x for _, x in kept)
    x = np.array(list(copies), dtype=float)
    w = np.array([copies[v] if weights == "count" else 1 for v in copies], dtype=float)
    n = int(w.sum())
    sums = [sum(int(c) * int(m) for c, m in zip(col, w)) for col in zip(*copies)]
    mean = np.array([s / n for s in sums])
    v = ((x - mean) * w[:, None]).T @ (x - mean) / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    out = []
    for i, own in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(own, sums))
        out.append((i, n, deviation, (np.array(own) - mean) @ axes / np.sqrt(values)))
    return out, values / v.trace()


def test_query_against_brute_force(spark, sf):
    want, explained = brute([(r["vec_id"], r["embedding"]) for r in table(sf, "embeddings")])
    got = defaultdict(dict)
    errors = set()
    for r in queries.op11_whitening(spark, sf).collect():
        got[r["vec_id"]][r["component"]] = r
        errors.add(r["identity_error"])
    assert len(errors) == 1 and errors.pop() < 1e-9
    assert len(got) == len(want)
    signs = None
    for i, n, deviation, w in want:
        own = [got[i][c] for c in range(1, 17)]
        assert {(r["n"], r["deviation"]) for r in own} == {(n, deviation)}
        assert np.allclose([r["explained"] for r in own], explained, rtol=1e-9)
        mine = np.array([r["whitened"] for r in own])
        signs = np.sign(mine * w) if signs is None else signs
        assert np.allclose(mine, w * signs, atol=1e-8)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_copies_weigh_one_or_their_number(spark, weights):
    r = np.random.default_rng(4)
    base = [r.normal(0, 1, 5).astype(np.float32).tolist() for _ in range(60)]
    rows = [(i, base[i % 60] if i % 3 else base[0]) for i in range(600)]  # a third is one vector
    want, explained = brute(rows, weights, 3)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS x", "2 AS copies", "3 AS whitened")
    got = {g["vec_id"]: g for g in whiten.whiten(df, weights=weights, components=3).collect()}
    signs = None
    for i, n, deviation, w in want:
        g = got.pop(i)
        signs = np.sign(np.array(g["whitened"]) * w) if signs is None else signs
        assert (g["n"], g["deviation"]) == (n, deviation)
        assert np.allclose(g["whitened"], w * signs) and np.allclose(g["explained"], explained)
        assert g["identity_error"] < 1e-9
    assert not got


def test_vectors_of_all_kinds(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, -inf]),
        (6, [1.0, 0.5]), (6, [1.0, 0.5]), (None, [0.0, 1.0]), (7, [-0.01, 2.0]),
        (8, [3.0, 1.0, 2.0]),  # of another length, and alone in it
        (9, [1e30, -1e30, 0.0, 1.0]), (10, [0.0, 0.0, 0.0, 1.0]), (11, [5.0]), (12, [5.0]),
    ]
    got = whiten.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    ids = Counter(g["vec_id"] for g in got)
    assert ids == Counter([6, 6, None, 7, 8, 9, 10, 11, 12])
    by = {g["vec_id"]: g for g in got}
    assert by[6]["n"] == 3 and len(by[6]["whitened"]) == 2
    want = {i: d for i, _, d, _ in brute([r for r in rows if r[1] and len(r[1]) == 2 and r[0] not in (3, 4, 5)])[0]}
    assert {i: by[i]["deviation"] for i in want} == want
    assert by[8]["whitened"] == [None] * 3 and by[8]["explained"] == [0.0] * 3 and by[8]["deviation"] == 0
    assert by[9]["deviation"] is None and np.isclose(abs(by[9]["whitened"][0]), 1)
    assert by[11]["n"] == 1 and by[11]["whitened"] == [None]
    empty = whiten.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]


def test_each_distinct_vector_is_joined_back_without_a_hot_key(spark):
    rows = [(i, [float(i % 7), 1.0] if i % 3 else [9.0, 9.0]) for i in range(4000)]
    out = whiten.whiten(spark.createDataFrame(rows, SCHEMA))
    assert out.count() == 4000
    assert out.select("vec_id").distinct().count() == 4000
