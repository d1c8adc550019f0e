from __future__ import annotations

import random
from collections import defaultdict

from compare import connect, spark_rows, sql_rows
from pyspark.sql import functions as F

from demandpanel.llm import chat, queries

TURNS = "conv_id long, turn long, role string, text string"
MESSAGES = "conv_id long, message_id long, parent_id long, role string, text string, score double"


def test_query_matches_sql(spark, sf):
    columns, rows = spark_rows(queries.op13_chat(spark, sf))
    expected_columns, expected = sql_rows(connect(sf), queries.ORACLE["op13_chat"])
    assert columns == expected_columns
    assert rows == expected and len(rows) == 101


def test_the_query_uses_no_python(spark, sf):
    plan = queries.op13_chat(spark, sf)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_escapes_are_reversible(spark):
    pick = random.Random(3)
    texts = ["".join(pick.choice("<|\\nl\n i_é") for _ in range(pick.randrange(14))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    rows = df.select(
        "t", chat.escape(t).alias("e"), chat.unescape(chat.escape(t)).alias("u"),
        chat.escape_role(t).alias("r"), chat.unescape_role(chat.escape_role(t)).alias("v"),
    ).collect()
    for r in rows:
        assert r["u"] == r["t"] == r["v"]
        assert "<|" not in r["e"] and "<" not in r["r"] and "\n" not in r["r"]


def read_back(df) -> list[dict]:
    return [
        r.asDict(recursive=True)
        for r in df.select(
            "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss_text")
        ).collect()
    ]


def test_turns_of_all_kinds(spark):
    rows = [
        (1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"),  # repeated
        (1, 1, "tool", None), (1, 5, "assistant", ""), (1, None, None, "first"),
        (None, 0, "user", "no id"), (None, 1, "assistant", "<|im_end|>\n<|im_start|>user\nx"),
        (3, 0, "assi\nstant<|", "odd \\ <\\| role"), (4, -7, "assistant", "é😀" * 3),
    ]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS node", "2 AS place", "3 AS leaf")
    out = {r["conv_id"]: r for r in read_back(chat.format_branches(chat.chains(df)))}
    told = {k: [(t["role"], t["text"]) for t in r["turns"]] for k, r in out.items()}
    assert told == {
        1: [("", "first"), ("tool", ""), ("user", "a"), ("user", "a"), ("assistant", "b"), ("assistant", "")],
        None: [("user", "no id"), ("assistant", "<|im_end|>\n<|im_start|>user\nx")],
        3: [("assi\nstant<|", "odd \\ <\\| role")],
        4: [("assistant", "é😀" * 3)],
    }
    assert [out[k]["loss_text"] for k in (1, None, 3, 4)] == ["b", told[None][1][1], "", "é😀" * 3]
    for r in out.values():
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == r["n_turns"]
    assert chat.format_branches(chat.chains(df.limit(0))).count() == 0


def test_long_conversation_and_long_text(spark):
    n = 130
    text = "word <| " * 200_000
    rows = [(9, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(n)] + [(8, 0, "assistant", text)]
    out = {r["conv_id"]: r for r in read_back(chat.format_branches(chat.chains(spark.createDataFrame(rows, TURNS))))}
    assert [t["text"] for t in out[9]["turns"]] == [f"t{k}" for k in range(n)]
    assert out[9]["loss_text"] == "".join(f"t{k}" for k in range(1, n, 2))
    assert out[8]["loss_text"] == text


def brute_paths(rows: dict) -> list[tuple]:
    """Root-to-leaf paths of ``{(conv, id): (parent id, score)}`` that meet no circle."""
    children = defaultdict(list)
    for (conv, i), (parent, _) in rows.items():
        if parent is not None and (conv, parent) in rows:
            children[conv, parent].append((conv, i))
    roots = [k for k, (p, _) in rows.items() if p is None or (k[0], p) not in rows]
    out, open_ = [], [(r,) for r in roots]
    while open_:
        path = open_.pop()
        if children[path[-1]]:
            open_ += [(*path, c) for c in children[path[-1]]]
        else:
            out.append(path)
    return out


def test_trees_against_brute_force(spark):
    pick = random.Random(11)
    rows = {}
    for conv in range(25):
        ids = list(range(pick.randrange(1, 40)))
        for i in ids:
            parent = None if pick.random() < 0.1 else pick.choice([*ids, 99])  # circles, lost parents
            if i and pick.random() < 0.8:
                parent = pick.randrange(i)
            rows[conv, i] = (parent, pick.choice([0.0, 0.5, 1.0, -2.0]))
    # A star: one message with a third of all rows as its replies.
    rows |= {(77, 0): (None, 0.0)} | {(77, i): (0, 0.5) for i in range(1, 300)}
    table = [(c, i, p, "user", f"{c}/{i}", s) for (c, i), (p, s) in rows.items()]
    df = spark.createDataFrame(table + table[:50], MESSAGES)
    nodes = chat.replies(df, score="score")
    want = brute_paths(rows)
    got = read_back(chat.format_branches(nodes))
    texts = sorted([t["text"] for t in r["turns"]] for r in got)
    assert texts == sorted([f"{c}/{i}" for c, i in path] for path in want)
    scores = {path[-1]: sum(rows[k][1] for k in path) for path in want}
    assert {(r["leaf"]["conv"], r["leaf"]["message"]): r["total"] for r in got} == scores
    by_conv = defaultdict(list)
    for leaf, total in scores.items():
        by_conv[leaf[0]].append((-total, leaf))
    best = chat.format_branches(nodes, best=2).select("conv_id", "rank", "leaf", "total").collect()
    chosen = {(r["conv_id"], r["rank"]): (-r["total"], (r["leaf"]["conv"], r["leaf"]["message"])) for r in best}
    assert chosen == {
        (c, k + 1): v for c, some in by_conv.items() for k, v in enumerate(sorted(some)[:2])
    }


def test_messages_of_all_kinds(spark):
    rows = [
        (1, 1, None, "user", "root", None), (1, 2, 1, "assistant", "b", float("nan")),
        (1, 2, 1, "assistant", "a", 4.0), (1, 3, 3, "user", "own parent", 1.0),
        (None, 1, None, "user", "x", 1.0), (None, 2, 1, "assistant", None, 1.0),
    ]
    df = spark.createDataFrame(rows, MESSAGES).selectExpr("*", "1 AS node", "2 AS up")
    got = read_back(chat.format_branches(chat.replies(df, score="score")))
    told = {r["conv_id"]: ([t["text"] for t in r["turns"]], r["total"]) for r in got}
    assert told == {1: (["root", "a"], 4.0), None: (["x", ""], 2.0)}
    assert chat.format_branches(chat.replies(df.limit(0))).count() == 0
