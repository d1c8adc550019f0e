from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.corpus import by_id, documents, table
from pyspark import cloudpickle
from pyspark.sql import functions as F

from demandpanel.llm import lm, queries

ASCII = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII)), ""]


@pytest.fixture(scope="module")
def result(spark, sf):
    return by_id(queries.op5_lm_scoring(spark, sf))


def test_query_against_brute_force(result, sf):
    docs = table(sf, "documents")
    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2 for d in docs}
    count = Counter(w for d in docs if not held[d["doc_id"]] for w in split(d["text"]))
    total, distinct = sum(count.values()), len(count)
    assert len(result) == len(docs)
    for d in docs:
        row, own = result[d["doc_id"]], split(d["text"])
        assert row["held_out"] == held[d["doc_id"]] and row["train_tokens"] == total
        assert row["n_tokens"] == len(own) and row["n_known"] == sum(w in count for w in own)
        base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in own)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)


def test_network_beats_the_counts_on_held_out_texts(result):
    held = [r for r in result.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in result.values())


PER = 4
HEAD = 2 * PER * PER
INPUTS, CLASSES = HEAD + lm.TAIL + 1, 2 * PER + lm.TAIL + 1


def network(seed=0):
    r = np.random.default_rng(seed)
    net = lm.Network(PER, r.normal(0, 1, CLASSES), r.normal(0, 1, (2 * PER, PER)))
    for name in ("c", "w"):
        net.p[name] = r.normal(0, 0.3, net.p[name].shape)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    return net, r


def test_gradient():
    net, r = network()
    code, goal = r.integers(0, INPUTS, (2, 5, 7))
    goal[1, 4:] = -1  # the end of a stream
    h = r.normal(0, 0.5, (5, lm.HIDDEN))
    _, grad, _ = net.loss(code, goal, h)
    assert set(grad) == set(net.p)
    for name, g in grad.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        net.p[name][at] += 1e-5
        more = net.loss(code, goal, h)[0]
        net.p[name][at] -= 2e-5
        less = net.loss(code, goal, h)[0]
        net.p[name][at] += 1e-5
        assert np.isclose(g[at], (more - less) / 2e-5, rtol=1e-4)


def test_every_token_of_a_stream_teaches(monkeypatch):
    net, r = network(4)
    seen = []
    loss = net.loss
    monkeypatch.setattr(net, "loss", lambda c, g, h: seen.append((c, g)) or loss(c, g, h))
    for n in (1, 5, 47, 100, 5000):
        seen.clear()
        stream = r.integers(0, INPUTS, n)
        net.train(stream, 3)
        lanes = [np.concatenate(x) for x in zip(*[list(g) for _, g in seen])]
        goals = np.concatenate(lanes)
        assert (goals[goals >= 0] == stream).all() and (goals >= 0).sum() == n


def test_windows_carry_the_state(monkeypatch):
    net, r = network(1)
    texts = [r.integers(0, INPUTS, n) for n in (1, 5, 64, 65, 200, 33)]
    want = []
    for t in texts:
        h, last, total = np.zeros((1, lm.HIDDEN)), 3, 0.0
        for code in t:
            h, _ = net.step(np.array([last]), h)
            total += net.log_prob(h, np.array([code]))[0][0]
            last = code
        want.append(total)
    for window, together in ((32, 512), (5, 2)):
        monkeypatch.setattr(lm, "WINDOW", window)
        monkeypatch.setattr(lm, "TOGETHER", together)
        np.testing.assert_allclose(net.score(texts, 3), want, rtol=1e-4)


def test_probabilities_sum_to_one():
    net, r = network(2)
    h = r.normal(0, 1, (1, lm.HIDDEN)).repeat(INPUTS, 0)
    logs, _ = net.log_prob(h, np.arange(INPUTS))
    assert math.isclose(np.exp(logs).sum(), 1, rel_tol=1e-9)
    n = np.arange(1, 1001)
    tail = np.bincount(np.log2(n).astype(int), n, lm.TAIL)
    words = lm.Vocabulary(int(n.sum()), 1000, PER, {}, np.zeros(HEAD), tail)
    ids = words.ids(np.full(1000, -1), n)
    share = np.bincount(ids, np.exp(words.share(ids, n)))
    assert np.allclose(share[share > 0], 1)
    # One less makes the class below where the count is a power of two, the unknown where it is one.
    less = words.ids(np.full(1000, -1), n - 1)
    changed = less != ids
    assert (n[changed] == 2 ** np.arange(10)).all()
    assert (lm._without(ids[changed], words) == less[changed]).all()


def test_the_largest_score_is_taken_off_only_where_it_must_be(monkeypatch):
    net, r = network(3)
    h, code = r.normal(0, 0.5, (400, lm.HIDDEN)), r.integers(0, INPUTS, 400)

    def found():
        grad = {k: np.zeros_like(net.p[k]) for k in ("c", "cb", "w", "wb")}
        logs, back = net.log_prob(h, code, grad)
        return [logs, back, *grad.values()]

    want = found()
    monkeypatch.setattr(lm, "STEEP", 0.0)  # always
    for a, b in zip(found(), want, strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)
    monkeypatch.undo()
    net.p["cb"][0] = 5000.0  # an exponential that overflows
    assert all(np.isfinite(x).all() for x in found())


def split_up(spark, texts, teaches="doc_id <= 4"):
    docs = documents(spark, texts).selectExpr("*", "1 AS block", "'x' AS score", "2 AS draw", "3 AS words")
    scores, model = lm.learn_and_score(docs, F.expr(teaches))
    return scores, model


def test_cases(spark):
    texts = {1: None, 2: "", 3: "A b\tB", 4: "A b\tB", 5: "new", 6: "a " * 30_000}
    scores, model = split_up(spark, texts)
    rows = by_id(scores)
    assert [rows[i]["n_tokens"] for i in range(1, 7)] == [1, 1, 4, 4, 2, 30_001]
    assert [rows[i]["n_known"] for i in range(1, 7)] == [1, 1, 4, 4, 1, 30_001]
    assert rows[3]["score"] == pytest.approx(rows[4]["score"]) and model.vocabulary.total == 10


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b")] * 3 + [(7, "a b"), (7, "c"), (8, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores, _ = lm.learn_and_score(docs, F.col("doc_id").isNull())
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"]) for r in scores.collect())
    assert got == [(0, 3, 3)] * 3 + [(7, 2, 1), (7, 3, 3), (8, 3, 3)]
    same = [r["score"] for r in scores.where("n_tokens = 3").collect()]
    assert len(same) == 5 and max(same) - min(same) < 1e-4


def test_empty_tables(spark):
    scores, model = split_up(spark, [])
    assert scores.count() == 0 and model.vocabulary.total == 0
    scores, model = split_up(spark, ["unseen words"], "false")
    assert [r["n_known"] for r in scores.collect()] == [0]
    assert all(r["score"] < 0 for r in scores.collect())


def test_blocks_and_slices_do_not_matter(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    teaches = F.col("doc_id") % 3 == 0

    def coded():
        parts = lm.split(docs, teaches)
        counts = lm.count_words(parts)
        return by_id(lm.coded(parts, counts, lm.vocabulary(counts))), counts.count()

    want = coded()
    for name, value in (("BLOCK_TOKENS", 900), ("SLICE", 70), ("WORDS", 50)):
        monkeypatch.setattr(lm, name, value)
    assert coded() == want


def test_a_very_long_text(spark):
    scores, _ = split_up(spark, {1: "some words to be read\n" * 40_000, 2: "words"}, "true")
    rows = by_id(scores)
    assert rows[1]["n_tokens"] == 200_001 and rows[1]["score"] > rows[1]["base_score"]


def test_more_text_teaches_more(spark, sf):
    """What the network reads grows with the corpus, and so does what it knows beyond the counts."""
    docs = spark.read.parquet(f"{sf.replace('0.01', '0.1')}/documents.parquet").where("length(text) < 6000")
    held = F.col("doc_id") % 9 == 0
    found = []
    for share in (40, 2):
        some = docs.where(held | (F.col("doc_id") % share == 1))
        scores, model = lm.learn_and_score(some, ~held)
        net = scores.where(held).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
        found.append((model.vocabulary.size, (net[0] - net[1]) / net[2]))
    assert found[1][0] > found[0][0] and found[1][1] > found[0][1] > 0


def test_every_training_text_teaches_the_network(spark, monkeypatch):
    """A corpus of many parts is read whole, each training text in one round, and no other text."""
    monkeypatch.setattr(lm, "VISITS", 1)
    texts = {i: " ".join(f"w{i % 50} v{j % 7}" for j in range(200)) for i in range(1600)}
    docs, teaches = documents(spark, texts), F.col("doc_id") % 7 != 2
    parts = lm.split(docs, teaches)
    counts = lm.count_words(parts)
    words = lm.vocabulary(counts)
    coded = lm.coded(parts, counts, words)
    read = spark.sparkContext.accumulator(0)
    train = lm.Network.train

    def counting(self, stream, first, *rest):
        read.add(len(stream))
        return train(self, stream, first, *rest)

    monkeypatch.setattr(lm.Network, "train", counting)
    cloudpickle.register_pickle_by_value(lm)
    try:
        lm.train(coded, words)
    finally:
        cloudpickle.unregister_pickle_by_value(lm)
    want = sum(401 for i in texts if i % 7 != 2)
    assert want > 1 << 19 and read.value == want == words.total
