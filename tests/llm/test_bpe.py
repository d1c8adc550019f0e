from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from llm.corpus import by_id, documents, table

from demandpanel.llm import bpe, queries

RANKS = bpe.read_ranks(public_tokenizers.path(queries.RANKS))
PEER = tiktoken.Encoding(
    "peer", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(RANKS, public_tokenizers.PATTERN)


def test_query_against_library(spark, sf):
    got = by_id(queries.op3_byte_bpe(spark, sf))
    for d in table(sf, "documents"):
        ids, row = PEER.encode_ordinary(d["text"]), got.pop(d["doc_id"])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()
    assert not got


ALPHABETS = ["ab ", "a", "the '", "'rels lvdm", " \n\t a", "0123 .", "é日本 語", "x!?-' 1\n", "  "]


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 64])
def test_trees_of_any_depth_agree_with_library(codec, monkeypatch, leaf):
    monkeypatch.setattr(bpe, "LEAF_CHARS", leaf)
    monkeypatch.setattr(bpe, "LEAF_BYTES", leaf)
    monkeypatch.setattr(bpe, "LEAF_TOKENS", leaf)
    monkeypatch.setattr(bpe, "SHORT_BYTES", leaf)
    codec.cache.clear()
    pick = random.Random(leaf)
    for _ in range(400):
        letters = pick.choice(ALPHABETS)
        text = "".join(pick.choice(letters) for _ in range(pick.randrange(1, 90)))
        ids = codec.encode(text)
        assert ids.tolist() == PEER.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()


def test_long_matches(codec):
    pick = random.Random(3)
    for text in [
        "a" * 30_000,
        "ab" * 9_000,
        "".join(pick.choice("etaoin") for _ in range(20_000)),
        " " * 20_000 + "x",
        "=-" * 9_000,
    ]:
        assert codec.encode(text).tolist() == PEER.encode_ordinary(text)


def test_special_strings_are_text(codec):
    assert codec.encode("<|endoftext|>").tolist() == PEER.encode_ordinary("<|endoftext|>")


def test_null_empty_repeated_and_clashing(spark):
    docs = documents(spark, [None, "", "hi there", "hi there"]).selectExpr(
        "*", "'mine' AS ids", "1 AS decoded"
    )
    ranks = bpe.broadcast_ranks(spark, public_tokenizers.path(queries.RANKS))
    rows = by_id(
        bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks, public_tokenizers.PATTERN)
    )
    assert [rows[i]["ids"] for i in range(4)] == [[], [], [5303, 612], [5303, 612]]
    assert [bytes(rows[i]["decoded"]) for i in range(4)] == [b"", b"", b"hi there", b"hi there"]
    assert rows[0]["text"] is None and rows[2]["source"] == "src0"
    empty = bpe.encode(documents(spark, []), ranks, public_tokenizers.PATTERN)
    assert empty.count() == 0


def test_round_trip_of_null_empty_repeated_and_clashing(spark):
    docs = documents(spark, [None, "", "hi there", "hi there"]).selectExpr("*", "'mine' AS ids")
    ranks = bpe.broadcast_ranks(spark, public_tokenizers.path(queries.RANKS))
    out = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    assert sorted(out.columns) == sorted(docs.columns)
    rows = by_id(out)
    assert [rows[i]["ids"] for i in range(4)] == [[], [], [5303, 612], [5303, 612]]
    assert [bytes(rows[i]["text"]) for i in range(4)] == [b"", b"", b"hi there", b"hi there"]
    assert bpe.round_trip(documents(spark, []), ranks, public_tokenizers.PATTERN).count() == 0
