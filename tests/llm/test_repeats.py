from __future__ import annotations

import hashlib
import random

from llm.corpus import by_id, documents, table

from demandpanel.llm import queries, repeats


def brute(texts: dict, window: int = 100) -> dict:
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        away = bytearray(len(data))
        for p in range(len(data) - window + 1):
            one = data[p : p + window]
            if one in seen:
                away[p : p + window] = b"\x01" * window
            seen.add(one)
        kept = bytes(b for b, a in zip(data, away, strict=True) if not a)
        runs = sum(a and (not p or not away[p - 1]) for p, a in enumerate(away))
        out[i] = (len(data), sum(away), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_query_against_brute_force(spark, sf):
    got = {
        i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
        for i, r in by_id(queries.op4_repeats(spark, sf)).items()
    }
    want = brute({d["doc_id"]: d["text"] for d in table(sf, "documents")})
    assert got == want
    assert any(0 < w[1] < w[0] for w in want.values())


def small(df):
    return {
        i: (r["n_bytes"], sum(s["length"] for s in r["spans"]), len(r["spans"]),
            hashlib.sha256(bytes(r["kept"])).hexdigest())
        for i, r in by_id(df).items()
    }


def test_short_windows_hot_minimizers_and_runs(spark, monkeypatch):
    pick = random.Random(4)
    texts = {i: "".join(pick.choice("ab") for _ in range(pick.randrange(60))) for i in range(60)}
    texts |= {60: None, 61: "", 62: "a" * 500, 63: "é" * 40, 64: "ab" * 90, 65: texts[3]}
    texts[66] = "".join(chr(97 + (i * i) % 26) for i in range(30_000))
    docs = documents(spark, texts).selectExpr("*", "1 AS doc", "'x' AS spans")
    for segments, size in ((2000, 1 << 19), (3, 64)):
        monkeypatch.setattr(repeats, "SEGMENTS", segments)
        monkeypatch.setattr(repeats, "ARRAY_BYTES", size)
        got = small(repeats.remove_repeats(docs, window=12, gram=4))
        assert got == brute(texts, 12)


def test_maximal_repeats_have_all_occurrences():
    parts = [b"xabcdey", b"zabcdeq", b"abcd", b"wbcdew"]
    found = {(n, tuple(sorted(where))) for n, where in repeats.maximal_repeats(parts, 3)}
    assert found == {
        (5, ((0, 1), (1, 1))),
        (4, ((0, 1), (1, 1), (2, 0))),
        (4, ((0, 2), (1, 2), (3, 1))),
        (3, ((0, 2), (1, 2), (2, 1), (3, 1))),
    }


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "".join(chr(97 + (i * 7) % 23) for i in range(23)) * 1 + "0123456789" * 9
    docs = documents(spark, {1: text, 2: text})
    both = docs.unionByName(docs).unionByName(
        docs.selectExpr("CAST(NULL AS bigint) doc_id", "text", "lang", "source", "n_chars")
    )
    rows = [
        (r["doc_id"], sum(s["length"] for s in r["spans"]))
        for r in repeats.remove_repeats(both).collect()
    ]
    own = brute({1: text, 2: text})
    assert sorted(rows, key=str) == sorted(
        [(1, own[1][1])] * 2 + [(2, own[2][1])] * 2 + [(None, 0)] * 2, key=str
    )
    assert repeats.remove_repeats(documents(spark, [])).count() == 0
