from __future__ import annotations

import random
import re

from llm.corpus import by_id, documents, table

from demandpanel.llm import neardup, queries
from demandpanel.llm.graph import components

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def shingles(text):
    w = WORD.findall((text or "").encode().lower())
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(texts: dict[int, str | None], threshold: float = 0.8):
    sets = {i: shingles(t) for i, t in texts.items()}
    links, root = dict.fromkeys(sets, 0), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids, places = sorted(sets), {}
    for i in ids:
        for s in sets[i]:
            places.setdefault(s, []).append(i)
    for i in ids:
        near = {j for s in sets[i] for j in places[s] if j > i}
        for j in near:
            common = len(sets[i] & sets[j])
            if common >= threshold * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (find(i), links[i]) for i in ids}


def result(df):
    return {i: (r["class_id"], r["n_links"]) for i, r in by_id(df).items()}


def test_query_against_brute_force(spark, sf):
    got = result(queries.op1_near_duplicates(spark, sf))
    want = brute({d["doc_id"]: d["text"] for d in table(sf, "documents")})
    assert got == want
    assert sum(n > 0 for _, n in want.values()) > 50


def test_blocks_chains_and_copies(spark, monkeypatch):
    pick = random.Random(1)
    base = [f"w{pick.randrange(10**6)}" for _ in range(60)]
    texts = {}
    for i in range(40):  # each differs from the one before by a word at the end
        texts[i] = " ".join(base[i : i + 30])
    for i in range(40, 60):
        texts[i] = texts[7].upper() + "!"
    texts |= {60: None, 61: "", 62: "...", 63: "short one", 64: "Short, one", 65: "w " * 30_000}
    docs = documents(spark, texts).selectExpr("*", "'x' AS class_id", "1 AS node", "2 AS key")
    want = brute(texts)
    for size in (4, 256):
        monkeypatch.setattr(neardup, "BLOCK", size)
        assert result(neardup.near_duplicates(docs)) == want
    kept = sorted(r["doc_id"] for r in neardup.one_of_each(docs).collect())
    assert kept == sorted({c for c, _ in want.values()})
    assert set(neardup.one_of_each(docs).columns) == set(docs.columns)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = documents(spark, {1: "a b c d e f g", 2: "z y x"})
    both = docs.unionByName(docs).unionByName(docs.selectExpr("CAST(NULL AS bigint) doc_id", "text", "lang", "source", "n_chars"))
    rows = neardup.near_duplicates(both).collect()
    assert len(rows) == 6 and {r["class_id"] for r in rows} == {1, 2}
    assert neardup.one_of_each(both).count() == 4
    assert neardup.near_duplicates(documents(spark, [])).count() == 0


def test_bands_reach_the_recall():
    for rows in (3, 5, 8):
        n = neardup.bands_for(0.8, 0.9999, rows)
        assert 1 - (1 - 0.8**rows) ** n >= 0.9999 > 1 - (1 - 0.8**rows) ** (n - 1)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(70)]
    star = [(1000, k) for k in range(1001, 1400)]
    got = components(spark.createDataFrame(path + star, "a long, b long")).collect()
    want = {i: 0 for i in range(71)} | {i: 1000 for i in range(1000, 1400)}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_one_of_each_loses_nothing_by_its_id(spark):
    long = "one two three four five six seven eight nine ten " * 4
    rows = [
        (5, long, "a"), (3, long + "more", "b"), (None, long, "c"),  # a class; the least id stays
        (7, "some other text of many words here", "d"), (7, "and a third one under the same id", "e"),
        (None, "copies without any id are copies too", "f"), (None, "copies without any id are copies too", "f"),
        (8, "repeated rows are copies as well, too", "g"), (8, "repeated rows are copies as well, too", "g"),
        (9, None, "h"), (9, None, "h"), (None, "", "i"), (10, "...", "j"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, class_id string").selectExpr("*", "1 AS node", "2 AS key")
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["class_id"] for r in kept.collect()) == list("bdefghhij")
    assert neardup.one_of_each(docs.limit(0)).count() == 0
