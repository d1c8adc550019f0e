from __future__ import annotations

import math
from collections import Counter

import numpy as np
from llm.corpus import SCHEMA, by_id, documents, table

from demandpanel.llm import langid, queries


def test_held_out_accuracy(spark, sf):
    got = by_id(queries.op9_language(spark, sf))
    docs = table(sf, "documents")
    assert len(got) == len(docs)
    held = [d for d in docs if got[d["doc_id"]]["held_out"]]
    assert 0.15 < len(held) / len(docs) < 0.35
    right = sum(got[d["doc_id"]]["lang_pred"] == d["lang"] for d in held)
    assert right >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def packed(gram: str) -> int:
    out = 0
    for ch in gram:
        out = out << 16 | ord(ch)
    return out


def kneser_ney(texts: list[str]):
    """Interpolated Kneser-Ney by its recursive definition."""
    counts = {4: Counter(), 3: Counter(), 2: Counter(), 1: Counter()}
    for t in texts:
        line = "   " + " ".join(t.split()) + " "
        counts[4].update(line[i : i + 4] for i in range(len(line) - 3))
    for n in (3, 2, 1):
        counts[n].update(g[1:] for g in counts[n + 1])

    def cut(n):
        once, twice = (sum(c == k for c in counts[n].values()) for k in (1, 2))
        return once / (once + 2 * twice) if once else 0.5

    def prob(gram):
        n = len(gram)
        if not n:
            return 1 / (len(counts[1]) + 1)
        same = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        if not same:
            return prob(gram[1:])
        total, d = sum(same.values()), cut(n)
        rest = d * len(same) / total * prob(gram[1:])
        return max(same.get(gram, 0) - d, 0) / total + rest

    return counts, prob


def test_probabilities_against_definition():
    texts = ["abra cadabra", "a banana band", "cab"]
    counts, prob = kneser_ney(texts)
    grams = sorted(counts[4])
    table4 = (
        np.array(sorted(packed(g) for g in grams), np.uint64),
        np.array([counts[4][g] for g in sorted(grams, key=packed)]),
    )
    models = langid.Models({"x": table4})
    for gram in [*grams, "abrz", "zzzz", "zban", " zzz", "dabc", "zz a"]:
        got = models.log_prob(4, np.array([packed(gram)], np.uint64))[0, 0]
        assert math.isclose(got, math.log(prob(gram)), rel_tol=1e-4), gram
    letters = [*counts[1], "?"]
    for head in ("abr", "   ", "zzz"):
        total = sum(
            math.exp(models.log_prob(4, np.array([packed(head + c)], np.uint64))[0, 0])
            for c in letters
        )
        assert math.isclose(total, 1, rel_tol=1e-4)


def test_characters():
    chars = langid.characters(["It's  FINE", "", "123", "ß𝒳!"])
    assert "".join(map(chr, chars.code.tolist())) == "it s fine ß￿ "
    assert chars.doc.tolist() == [0] * 10 + [3] * 3


def test_cases(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    models = langid.fit(docs)
    english = next(d["text"] for d in table(sf, "documents") if d["lang"] == "en")
    texts = [None, "", "123 !?", "🙂", english, english, english * 50, "日本語の文章です" * 9]
    own = documents(spark, texts).selectExpr("doc_id", "text", "'de' AS lang", "0.5 AS score")
    rows = by_id(langid.identify(own, models))
    assert [rows[i]["lang_pred"] for i in range(4)] == ["und"] * 4
    assert [rows[i]["lang_pred"] for i in range(4, 8)] == ["en", "en", "en", "und"]
    assert rows[7]["rejected"] and rows[0]["score"] == 0
    assert by_id(langid.identify(own, models, reject=False))[7]["lang_pred"] in models.languages


def test_empty_tables_and_unlabelled_texts(spark):
    none = langid.fit(documents(spark, []))
    assert none.languages == []
    docs = documents(spark, ["some text", None])
    rows = by_id(langid.identify(docs, none))
    assert [rows[i]["lang_pred"] for i in (0, 1)] == ["und", "und"]
    assert langid.identify(documents(spark, []), none).count() == 0
    bare = docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert langid.fit(bare).languages == []


def test_every_language_is_learned(spark, monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèàçñø"
    words = [letters[k : k + 3] for k in range(0, 36, 3)]
    texts = [f"{w} {w[::-1]} {w}{w[::-1]} " * 30 for w in words]
    rows = [(k, t, f"l{k:02d}", "src0", len(t)) for k, t in enumerate(texts)]
    one = spark.createDataFrame(rows, SCHEMA)
    for size in (langid.SAMPLE_BYTES, 0):  # all texts, and long texts of which no byte is expected
        monkeypatch.setattr(langid, "SAMPLE_BYTES", size)
        got = by_id(langid.identify(one, langid.fit(one)))
        assert [got[k]["lang_pred"] for k in range(12)] == [r[2] for r in rows]
    monkeypatch.undo()
    null = one.selectExpr("CAST(NULL AS bigint) AS doc_id", "text", "lang")
    assert (langid.fit(null).limit == np.inf).all()
    got = by_id(langid.identify(one, langid.fit(null)))
    assert [got[k]["lang_pred"] for k in range(12)] == [r[2] for r in rows]
