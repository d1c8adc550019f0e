from __future__ import annotations

import hashlib
import json
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers as vocabularies
import pytest
import sentencepiece
from llm.corpus import by_id, documents, table
from tokenizers import Tokenizer

from demandpanel.llm import align, queries

A, B = vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def peers():
    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    byte = {c: b for c, b in zip(map(chr, range(0x21, 0x7F)), range(0x21, 0x7F), strict=True)}
    byte |= {chr(b): b for b in [*range(0xA1, 0xAD), *range(0xAE, 0x100)]}
    rest = [b for b in range(256) if b not in byte.values()]
    byte |= {chr(0x100 + k): b for k, b in enumerate(rest)}
    entries = json.load(open(A, encoding="utf-8"))["model"]["vocab"]
    a_bytes = {i: e.encode() if e == "<|endoftext|>" else bytes(byte[c] for c in e) for e, i in entries.items()}
    two = sentencepiece.SentencePieceProcessor(model_file=B)

    def b_bytes(i):
        piece = two.id_to_piece(i)
        found = re.fullmatch("<0x(..)>", piece)
        return bytes.fromhex(found[1]) if found else piece.replace("▁", " ").encode()

    return one, a_bytes, two, b_bytes


def brute(text, peers):
    """Groups of ids and links (id of the first, of the second) of one text, by definition."""
    one, a_bytes, two, b_bytes = peers
    if not text:
        return [], [], []
    a = one.encode(" " + text, add_special_tokens=False).ids
    b = two.encode(text)
    data = (" " + text).encode()
    if b"".join(a_bytes[i] for i in a) != data or b"".join(b_bytes(i) for i in b) != data:
        return [], [], []
    ends = [list(np.cumsum([len(f) for f in x])) for x in ([a_bytes[i] for i in a], [b_bytes(i) for i in b])]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups, lo = [], 0
    for hi in cuts:
        groups.append(tuple([i for i, e in zip(x, y) if lo < e <= hi] for x, y in zip((a, b), ends)))
        lo = hi
    links = []
    j = 0
    for k, i in enumerate(a):
        start, end = (ends[0][k - 1] if k else 0), ends[0][k]
        while (ends[1][j]) <= start:
            j += 1
        m = j
        while m < len(b) and (ends[1][m - 1] if m else 0) < end:
            links.append((i, b[m]))
            m += 1
    return groups, links, (a, b)


def expected(texts: dict, peers) -> dict:
    found = {k: brute(t, peers) for k, t in texts.items()}
    count = Counter(p for _, links, _ in found.values() for p in set(links))
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = {}
    for k, (groups, links, tokens) in found.items():
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out[k] = {
            "doc_id": k, "n_a": len(tokens[0]) if tokens else 0, "n_b": len(tokens[1]) if tokens else 0,
            "n_groups": len(groups), "n_links": len(links),
            "n_best": sum(count[p] == most[p[0]] for p in links), "count_sum": sum(count[p] for p in links),
            "groups_sha256": hashlib.sha256(text.encode()).hexdigest() if text else "",
            "n_shared": sum(len(a) * len(b) for a, b in groups),
        }
    return out


def test_query_against_brute_force(spark, sf, peers, tmp_path):
    texts = {d["doc_id"]: d["text"] for d in table(sf, "documents") if d["doc_id"] % 3 == 0 or len(d["text"]) < 900}
    spark.read.parquet(f"{sf}/documents.parquet").where(
        f"doc_id IN ({','.join(map(str, texts))})"
    ).write.parquet(str(tmp_path / "documents.parquet"))
    assert by_id(queries.op12_alignment(spark, str(tmp_path))) == expected(texts, peers)


def test_texts_of_all_kinds(spark, peers, tmp_path, monkeypatch):
    pick = random.Random(8)
    letters = ["a", "e", " ", " ", "\n", "ß", "é", "ſ", "中", "文", "😀", "3", ".", "'s", "▁", "<|endoftext|>", "<s>", "<0x41>", "\x00", "\x1c", " ", "̀", "\t"]
    texts = [None, "", " ", "a", "  two  spaces ", "same", "same", "x" * 3000, "end \n"]
    texts += ["".join(pick.choice(letters) for _ in range(pick.randrange(30))) for _ in range(300)]
    texts += ["plain words and no more of it " * 40]
    schema = "doc_id bigint, text string"
    df = spark.createDataFrame(list(enumerate(texts)), schema)
    df.selectExpr("*", "1 AS block", "'x' AS groups", "2 AS codes", "3 AS n_a").write.parquet(str(tmp_path / "documents.parquet"))
    want = expected(dict(enumerate(texts)), peers)
    assert by_id(queries.op12_alignment(spark, str(tmp_path))) == want
    assert sum(r["n_a"] == 0 for r in want.values()) > 2


def test_repeated_rows_and_null_ids_and_no_rows(spark, peers):
    rows = [(1, "some words"), (1, "some words"), (None, "some"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = align.align_corpus(align.aligned(df, A, B, vocabularies.PATTERN)).collect()
    assert sorted((r["doc_id"] or 0, r["n_a"], r["n_best"], r["count_sum"]) for r in out) == [
        (0, 1, 1, 3), (1, 2, 2, 5), (1, 2, 2, 5), (2, 0, 0, 0)
    ]
    none = align.align_corpus(align.aligned(df.limit(0), A, B, vocabularies.PATTERN))
    assert none.count() == 0


def test_long_texts_are_aligned_in_parts(peers, monkeypatch):
    text = "words of it, 3.5 and more\n\nof  them: don't the'm ü é " * 60
    whole = align.Aligner(A, B, vocabularies.PATTERN)
    want = whole.rows([text])
    monkeypatch.setattr(align, "AT_ONCE", 50)
    assert len(align._parts(text)) > 40
    got = whole.long_row(text)
    for x, y in zip(got, want, strict=True):
        assert x == y if isinstance(x, list) else np.array_equal(x, y)
    odd = whole.long_row(text + "▁")  # one part that does not come back leaves none
    assert odd.numbers.sum() == 0 and odd.groups == [""]


def test_a_very_long_text(spark):
    text = "every word of a long text is aligned " * 60_000
    df = documents(spark, [text, "every word"])
    out = by_id(align.align_corpus(align.aligned(df, A, B, vocabularies.PATTERN).drop("groups")))
    assert out[0]["n_a"] > 400_000 and out[0]["n_links"] == out[0]["n_best"] > 400_000


def test_products_of_sparse_matrices():
    r = np.random.default_rng(2)
    for _ in range(50):
        shape = r.integers(1, 9, 3)
        dense = [(r.random((shape[0], shape[1])) < 0.4) * r.integers(1, 5, (shape[0], shape[1])),
                 (r.random((shape[1], shape[2])) < 0.4) * r.integers(1, 5, (shape[1], shape[2]))]
        made = []
        for m in dense:
            row, column = np.nonzero(m)
            sparse = align.csr(np.bincount(row, minlength=len(m)), column, m.shape[1])
            made.append(sparse._replace(value=m[row, column]))
        product = align.row_product(*made)
        out = np.zeros((shape[0], shape[2]), int)
        row = np.repeat(np.arange(shape[0]), np.diff(product.start))
        out[row, product.column] = product.value
        assert (out == dense[0] @ dense[1]).all()
        assert (align.product_sizes(*made) >= np.diff(product.start)).all()
        back = align.transposed(align.transposed(made[0]))
        assert all(np.array_equal(x, y) for x, y in zip(back, made[0], strict=True))


def test_shared_group_links(peers):
    both = align.Aligner(A, B, vocabularies.PATTERN)
    x = both.align(["unbelievable antidisestablishment", None, "zwölf Boxkämpfer"])
    links = x.shared()
    row = np.repeat(np.arange(len(x.a)), np.diff(links.start))
    want = {(i, j) for i in range(len(x.a)) for j in range(len(x.b)) if x.a_group[i] == x.b_group[j]}
    assert set(zip(row.tolist(), links.column.tolist())) == want
    assert x.n_shared().sum() == len(want) and x.n_shared()[1] == 0
    assert x.overlap.value.sum() == both.a_size[x.a].sum()
