from __future__ import annotations

import hashlib
import re

from compare import connect, spark_rows, sql_rows
from llm.corpus import by_id, documents, table
from pyspark.sql import functions as F

from demandpanel.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(ASCII))


def brute(text, items):
    own, hit, met = words(text), set(), set()
    for item, item_text in items:
        parts = words(item_text)
        n = min(13, len(parts))
        grams = {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)} if n else set()
        for i in range(len(own) - n + 1 if n else 0):
            if tuple(own[i : i + n]) in grams:
                hit.update(range(i, i + n))
                met.add(str(item))
    return len(own), len(hit), sorted(met)


def test_query_against_brute_force(spark, sf):
    items = [(b["item_id"], b["text"]) for b in table(sf, "benchmark")]
    got = by_id(queries.op2_decontaminate(spark, sf))
    some = 0
    for d in table(sf, "documents"):
        n, hit, met = brute(d["text"], items)
        row = got[d["doc_id"]]
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n, hit, len(met))
        assert row["items_sha256"] == hashlib.sha256(",".join(met).encode()).hexdigest()
        assert row["contaminated"] == (hit > 0 and 20 * hit >= n)
        some += hit > 0
    assert some


def test_query_against_sql(spark, sf):
    columns, rows = spark_rows(queries.op2_decontaminate(spark, sf))
    wanted, expected = sql_rows(connect(sf), queries.ORACLE["op2_decontaminate"])
    assert (columns, rows) == (wanted, expected)


ITEMS = [
    (10, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (9, "Étude no. 5"),
    (8, ""),
    (7, None),
    (None, "lonely words"),
    (10, "Étude no. 5"),
]


def frames(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    texts = [
        None,
        "",
        "!!!",
        "ONE two three, four five six seven eight nine ten eleven twelve thirteen",
        "one two three four five six seven eight nine ten eleven twelve",
        "a Étude NO 5 b",
        "étude no 5",
        "lonely words lonely",
        long + " étude Étude no 5 no " + long,
        "ends with Étude",
        "no 5 begins",
    ]
    docs = documents(spark, texts).withColumn("n_words", F.lit("kept"))
    return texts, docs, spark.createDataFrame(ITEMS, "item_id int, text string")


def test_cases(spark):
    texts, docs, bench = frames(spark)
    named = [(i, t) for i, t in ITEMS if i is not None]
    for limit in (decontaminate.BROADCAST_BYTES, 20):  # one block, and several
        rows = by_id(decontaminate.hits(docs, bench, block_bytes=limit))
        for i, text in enumerate(texts):
            n, hit, met = brute(text, ITEMS)
            found = rows[i]["contamination"]
            assert found["n_words"] == n
            assert sum(r["hi"] - r["lo"] for r in found["words"]) == hit
            assert found["items"] == brute(text, named)[2]
            assert rows[i]["n_words"] == "kept"


def test_removal(spark):
    _, docs, bench = frames(spark)
    found = decontaminate.hits(docs, bench)
    kept = by_id(decontaminate.without_documents(found))
    assert sorted(kept) == [0, 1, 2, 4, 6, 8, 9, 10]
    assert set(kept[0]) == set(docs.columns)
    cut = by_id(decontaminate.without_spans(found))
    assert cut[5]["text"] == "a  b" and cut[7]["text"] == " lonely" and cut[3]["text"] == ""
    assert cut[0]["text"] is None and cut[6]["text"] == "étude no 5"


def test_empty_tables(spark):
    _, docs, bench = frames(spark)
    assert decontaminate.hits(documents(spark, []), bench).count() == 0
    none = decontaminate.hits(docs, bench.limit(0))
    assert none.where(decontaminate.contaminated()).count() == 0
