from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import tiktoken
from llm.corpus import by_id, table
from llm.test_decontaminate import brute as hit_words
from llm.test_neardup import brute as near

from demandpanel.llm import bpe, pii, quality, queries


def test_stages_against_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        out = stage(spark, docs, sf)
        if name != "tokens":
            assert out.columns == docs.columns
        out.write.parquet(path)
        kept.append(by_id(docs))
        docs = spark.read.parquet(path)
    kept.append(by_id(docs))
    start, good, single, clean, private, tokens = kept
    model = quality.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    verdict = by_id(quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), model))
    assert set(good) == {i for i, r in verdict.items() if r["accepted"]}
    classes = near({i: r["text"] for i, r in good.items()})
    assert set(single) == {c for c, _ in classes.values()}
    items = [(b["item_id"], b["text"]) for b in table(sf, "benchmark")]
    hits = {i: hit_words(r["text"], items) for i, r in single.items()}
    assert set(clean) == {i for i, (n, hit, _) in hits.items() if not hit or 20 * hit < n}
    assert set(private) == set(clean)
    assert all(not pii.patterns(r["text"]) for r in private.values())
    assert all(r["n_chars"] == len(r["text"]) for r in private.values())
    network = pii.fit(spark.read.parquet(str(tmp_path / "decontamination")))
    for i, r in clean.items():
        assert private[i]["text"] == pii.redact_text(r["text"], pii.detect(r["text"], network)[1])
    peer = tiktoken.Encoding(
        "peer",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path(queries.RANKS)),
        special_tokens={},
    )
    assert set(tokens) == set(private)
    for i, r in tokens.items():
        assert r["text"] == private[i]["text"]
        assert r["ids"] == peer.encode_ordinary(r["text"]) and r["n_tokens"] == len(r["ids"])
    assert len(start) > len(good) > len(single) > len(clean) > 100


def test_stages_on_rows_of_all_kinds(spark, sf, tmp_path):
    """Null, empty, repeated and very long texts, null and repeated ids, clashing names, no rows."""
    words = "the quick brown fox jumps over the lazy dog near the old river bank today "
    texts = [None, "", "...", words, words, "call +49 (843) 555-7672 now", words * 900, "x" * 70_000]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], (None, words + "again", "en", "s", 1), (None, None, None, None, None), (3, "another text", "en", "s", 12)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema)
    extra = ["ids", "n_tokens", "spans", "key", "block", "class_id", "accepted", "contamination", "node"]
    docs = docs.selectExpr("*", *[f"'{c}' AS {c}" for c in extra])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        names = [c for c in docs.columns if c not in ("ids", "n_tokens")] + ["n_tokens", "ids"]
        assert out.columns == (names if name == "tokens" else docs.columns), name
        out.write.parquet(str(tmp_path / name))
        got = spark.read.parquet(str(tmp_path / name)).collect()
        assert all(r[c] == c for r in got for c in extra[2:]), name
        nulls = sum(r["text"] is None for r in got)
        if name == "near_duplicates":
            kept = sorted(str(r["text"])[:20] for r in got)
            assert nulls == 2 and len(got) == 9 and "another text" in kept
        elif name != "quality":
            assert len(got) == len(rows) and nulls == 2, name
        if name == "personal_data":
            assert [r["text"] for r in got if r["doc_id"] == 5] == ["call [PHONE] now"] * 2
        if name == "tokens":
            assert all(r["ids"] == [] and r["n_tokens"] == 0 for r in got if not r["text"])
        assert stage(spark, docs.limit(0), sf).count() == 0
