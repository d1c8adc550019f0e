"""Alignment of the tokens of two tokenizers over the same bytes.

Each tokenizer's tokens of a batch of texts are a sparse matrix of tokens by bytes, in compressed rows. The
row product of one with the transposed other links tokens whose byte ranges overlap, with the
number of bytes they share. Places where both end a token cut the text into groups; the product of the two
token-by-group matrices links tokens of one group.

Links are counted over the corpus by the number of documents that hold a pair of ids. Pairs are merged
per block of documents first, so a pair has one row a block, however common it is; the totals go back to the blocks.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandpanel.sources.checkpoints import written

#: Characters of text that are encoded and multiplied at once; a longer text is cut, see ``_parts``.
AT_ONCE = 1 << 18
#: Distinct pairs (summed over documents) that close a block of documents.
BLOCK_PAIRS = 1 << 20
#: A code is the first id in the upper bits, the second below.
ID_BITS = 31


class Csr(NamedTuple):
    """A sparse matrix in compressed rows: where each row begins, columns and values of the entries."""

    start: np.ndarray
    column: np.ndarray
    value: np.ndarray
    columns: int


def csr(sizes: np.ndarray, column: np.ndarray, columns: int) -> Csr:
    """A matrix of ones whose rows have ``sizes`` entries."""
    return Csr(np.r_[0, np.cumsum(sizes)], column, np.ones(len(column), np.int64), columns)


def transposed(m: Csr) -> Csr:
    """Columns become rows: a counting sort of the entries by column."""
    row = np.repeat(np.arange(len(m.start) - 1), np.diff(m.start))
    order = np.argsort(m.column, kind="stable")
    start = np.r_[0, np.cumsum(np.bincount(m.column, minlength=m.columns))]
    return Csr(start, row[order], m.value[order], len(m.start) - 1)


def row_product(a: Csr, b: Csr) -> Csr:
    """``a @ b`` row by row: each entry of a row of ``a`` brings the row of ``b`` that its column names,
    and the entries of one column are added up."""
    size = np.diff(b.start)[a.column]
    brought = np.repeat(np.arange(len(a.column)), size)
    within = np.arange(len(brought)) - np.repeat(np.cumsum(size) - size, size)
    at = b.start[a.column][brought] + within
    row = np.repeat(np.arange(len(a.start) - 1), np.diff(a.start))[brought]
    column, value = b.column[at], a.value[brought] * b.value[at]
    if len(row) and ((row[1:] == row[:-1]) & (column[1:] < column[:-1])).any():
        order = np.lexsort((column, row))
        row, column, value = row[order], column[order], value[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (column[1:] != column[:-1])][: len(row)])
    value = np.add.reduceat(value, first) if len(first) else value
    start = np.r_[0, np.cumsum(np.bincount(row[first], minlength=len(a.start) - 1))]
    return Csr(start, column[first], value, b.columns)


def product_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Entries that each row of ``a @ b`` is made of, without making them."""
    size = np.r_[0, np.cumsum(np.diff(b.start)[a.column])]
    return size[a.start[1:]] - size[a.start[:-1]]


def _byte_level() -> dict[str, int]:
    """The bytes that byte-level vocabularies write as characters: printable Latin-1 as it is, the
    others in order from U+0100."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(0x100 + k): b for k, b in enumerate(other)}


class ByteLevel:
    """A byte-level BPE vocabulary: ids of texts, and the bytes of ids.

    Texts of ASCII and Latin letters are encoded by ranks, the others by the tokenizer of the file: the ids
    are the same, ranks are faster, and the classes of these letters are the same in all versions of Unicode.
    """

    _PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\u024f\u2018-\u201d]*")

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)
        special = {t["content"] for t in vocabulary.get("added_tokens", [])}
        entries = vocabulary["model"]["vocab"]
        byte = _byte_level()
        self.bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes[i] = entry.encode() if entry in special else bytes(byte[c] for c in entry)
        ranks = {self.bytes[i]: i for entry, i in entries.items() if entry not in special}
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list = [None] * len(texts)
        other = []
        for k, text in enumerate(texts):
            if self._PLAIN.fullmatch(text):
                out[k] = self.fast.encode_ordinary(text)
            else:
                other.append(k)
        if other:
            found = self.whole.encode_batch_fast([texts[k] for k in other], add_special_tokens=False)
            for k, one in zip(other, found, strict=True):
                out[k] = one.ids
        return out


class Pieces:
    """A vocabulary of pieces with bytes to fall back to, which puts a space before each text."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            self.bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        # A text may be cut before a space if no piece goes on over one.
        self.cut_at_spaces = not any(" " in b.lstrip(b" ").decode("utf-8", "replace") for b in self.bytes)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


def _parts(text: str) -> list[str]:
    """Stretches of at least ``AT_ONCE`` characters, without the space between them: neither vocabulary has
    a token over a space between two ASCII letters, and both begin a text with a space."""
    out, lo = [], 0
    while m := _CUT.search(text, lo + AT_ONCE):
        out.append(text[lo : m.start()])
        lo = m.end()
    return [*out, text[lo:]]


class Aligner:
    """Both vocabularies, and the arrays that tell the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str, pattern: str):
        self.a, self.b = ByteLevel(a_path, pattern), Pieces(b_path)
        self.a_size, self.b_size = (np.array([len(x) for x in v.bytes]) for v in (self.a, self.b))
        # The written ids, each followed by what separates it from the next token.
        a, b = len(self.a.bytes), len(self.b.bytes)
        self.written = [f"{i}{s}" for s in ",|" for i in range(a)] + [f"{i}{s}" for s in ",;" for i in range(b)]

    def tokens(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of both; none where a text is null or empty, or the bytes of either differ from it."""
        some = [t for t in texts if t]
        a, b = self.a.encode([" " + t for t in some]), self.b.encode(some)
        found = zip(some, a, b, strict=True)
        return [self._checked(*next(found)) if t else ([], []) for t in texts]

    def _checked(self, text: str, a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
        data = (" " + text).encode()
        same = b"".join(map(self.a.bytes.__getitem__, a)) == data
        return (a, b) if same and b"".join(map(self.b.bytes.__getitem__, b)) == data else ([], [])

    def align(self, texts: list[str | None]) -> Alignment:
        """All texts side by side: no token and no group reaches from one into the next."""
        tokens = self.tokens(texts)
        n = len(texts)
        count = np.array([[len(a), len(b)] for a, b in tokens]).reshape(n, 2)
        a = np.fromiter(chain.from_iterable(x for x, _ in tokens), np.int64, count[:, 0].sum())
        b = np.fromiter(chain.from_iterable(x for _, x in tokens), np.int64, count[:, 1].sum())
        a_size, b_size = self.a_size[a], self.b_size[b]
        size = int(a_size.sum())
        place = np.arange(size)
        overlap = row_product(csr(a_size, place, size), transposed(csr(b_size, place, size)))
        a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        in_a = csr(np.ones(len(a), np.int64), a_group, len(ends))
        in_b = csr(np.ones(len(b), np.int64), b_group, len(ends))
        a_doc, b_doc = (np.repeat(np.arange(n), count[:, k]) for k in (0, 1))
        group_doc = np.zeros(len(ends), np.int64)
        group_doc[a_group] = a_doc
        return Alignment(a, b, a_doc, b_doc, a_group, b_group, group_doc, overlap, in_a, in_b, n)

    def rows(self, texts: list[str | None]) -> Rows:
        x = self.align(texts)
        doc, code, times = x.pairs()
        number = [np.bincount(of, minlength=x.n) for of in (x.a_doc, x.b_doc, x.group_doc)]
        links = np.bincount(doc, times, x.n).astype(np.int64)
        return Rows(np.array([*number, links, x.n_shared()]), self.groups(x), np.bincount(doc, minlength=x.n), code, times)

    def long_row(self, text: str) -> Rows:
        """The same for one text, part by part: both vocabularies end a token where a part ends."""
        if not self.b.cut_at_spaces:
            return self.rows([text])
        total, groups = np.zeros((5, 1), np.int64), []
        code, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in _parts(text):
            one = self.rows([part])
            if not one.numbers[0, 0]:  # other bytes than the text's
                return self.rows([None])
            total += one.numbers
            groups += one.groups
            code, which = np.unique(np.r_[code, one.code], return_inverse=True)
            times = np.bincount(which, np.r_[times, one.times]).astype(np.int64)
        return Rows(total, [";".join(groups)], np.array([len(code)]), code, times)

    def groups(self, x: Alignment) -> list[str]:
        """Ids by group of each text: those of the first, a bar, those of the second, semicolons between."""
        last_a = np.r_[x.a_group[1:] != x.a_group[:-1], True][: len(x.a)]
        last_b = np.r_[x.b_group[1:] != x.b_group[:-1], True][: len(x.b)]
        a_ids, b_ids = len(self.a.bytes), len(self.b.bytes)
        entry = np.r_[x.a + a_ids * last_a, 2 * a_ids + x.b + b_ids * last_b]
        order = np.lexsort((np.r_[np.zeros(len(x.a)), np.ones(len(x.b))], np.r_[x.a_group, x.b_group]))
        entry = entry[order].tolist()
        bounds = np.searchsorted(np.r_[x.a_doc, x.b_doc][order], np.arange(x.n + 1)).tolist()
        return ["".join(map(self.written.__getitem__, entry[p:q]))[:-1] for p, q in zip(bounds, bounds[1:])]


class Rows(NamedTuple):
    """Results by text: tokens of either, groups, links and shared links; groups written out; pairs of
    ids (``sizes`` of each text, one after another) and how often they are linked."""

    numbers: np.ndarray
    groups: list[str]
    sizes: np.ndarray
    code: np.ndarray
    times: np.ndarray


class Alignment(NamedTuple):
    """Tokens of a batch of texts: ids, text and group of each, and the overlaps as a matrix."""

    a: np.ndarray
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    group_doc: np.ndarray
    overlap: Csr
    in_a: Csr
    in_b: Csr
    n: int

    def shared(self) -> Csr:
        """Links of tokens of one group; a group of many tokens has many."""
        return row_product(self.in_a, transposed(self.in_b))

    def n_shared(self) -> np.ndarray:
        """Their number by text, without making them."""
        sizes = product_sizes(self.in_a, transposed(self.in_b))
        return np.bincount(self.a_doc, sizes, self.n).astype(np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Linked pairs of ids, once a text: text, code and number of links, by text and code."""
        row = np.repeat(np.arange(len(self.a)), np.diff(self.overlap.start))
        code = (self.a[row] << ID_BITS) | self.b[self.overlap.column]
        doc = self.a_doc[row]
        order = np.lexsort((code, doc))
        doc, code = doc[order], code[order]
        first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])][: len(doc)])
        return doc[first], code[first], np.diff(np.r_[first, len(doc)])


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(a_path: str, b_path: str, pattern: str) -> Aligner:
    """One for each worker: vocabularies take a second to read."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = (a_path, b_path, pattern)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``AT_ONCE`` characters together; a longer text is a run of its own."""
    lo = size = 0
    for hi, text in enumerate(texts):
        if hi > lo and size + len(text or "") > AT_ONCE:
            yield lo, hi
            lo, size = hi, 0
        size += len(text or "")
    if texts:
        yield lo, len(texts)


ALIGNED = (
    "block long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups string,"
    " codes array<long>, times array<int>"
)


def aligned(
    docs: DataFrame, a_path: str, b_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row's alignment, ``doc_id`` and:

    ``n_a, n_b, n_groups``: tokens of either and groups; ``n_links``: pairs of tokens that
    overlap; ``n_shared``: pairs of tokens of one group; ``groups``: the ids, as ``a1,a2|b1;a3|b2``;
    ``codes, times``: pairs of ids that are linked, coded and in order, and how often; ``block``: a number
    that neighbouring rows share, until they hold ``BLOCK_PAIRS`` codes.

    A text that is null or empty, or that either vocabulary does not give back byte by byte
    (after a space), has no tokens. No row moves; repeated rows are rows of their own. A long text is
    aligned in parts of ``AT_ONCE`` characters or more, cut between words of ASCII letters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path, pattern)
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in _slices(texts):
                alone = hi == lo + 1 and len(texts[lo] or "") > AT_ONCE
                found = both.long_row(texts[lo]) if alone else both.rows(texts[lo:hi])
                if held and held + len(found.code) > BLOCK_PAIRS:
                    block, held = block + 1, 0
                held += len(found.code)
                ends = np.r_[0, np.cumsum(found.sizes)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.array(np.full(hi - lo, block)),
                        *[pa.array(c) for c in found.numbers],
                        pa.array(found.groups, pa.string()),
                        pa.ListArray.from_arrays(ends, found.code),
                        pa.ListArray.from_arrays(ends, found.times.astype(np.int32)),
                    ],
                    ["doc_id", *[c.split()[0] for c in ALIGNED.split(", ")]],
                )

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, {ALIGNED}")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct codes of consecutive rows of a block, with the number of rows that hold them."""
    own, block, size = [], None, 0

    def merged() -> pa.RecordBatch:
        code, n = np.unique(np.concatenate(own), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(code), block)), pa.array(code), pa.array(n)], ["block", "code", "n"]
        )

    for batch in batches:
        blocks = batch.column("block").to_numpy()
        if not len(blocks):
            continue
        cuts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
        for lo, hi in zip(cuts, [*cuts[1:], len(blocks)], strict=True):
            if block is not None and (blocks[lo] != block or size > BLOCK_PAIRS):
                yield merged()
                own, size = [], 0
            block = int(blocks[lo])
            codes = batch.column("codes").slice(lo, hi - lo).flatten().to_numpy()
            own.append(codes)
            size += len(codes)
    if block is not None:
        yield merged()


def pair_counts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Codes by block, and ``code, n, best``: the rows of all blocks that hold a pair, and
    whether that is the most of any pair of the same first id, ties included."""
    here = rows.select("block", "codes").mapInArrow(_by_block, "block long, code long, n long")
    total = here.groupBy("code").agg(F.sum("n").alias("n"))
    first = F.shiftright("code", ID_BITS)
    most = total.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    known = total.withColumn("a", first).join(most, "a")
    # A first id has at most as many rows here as the second vocabulary has ids.
    return here.select("block", "code").distinct(), known.select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(rows: DataFrame) -> DataFrame:
    """``aligned`` rows without codes, with ``n_best`` and ``count_sum``.

    ``count_sum`` adds up, over all links of a row, how many rows of the whole table hold the
    link's pair of ids; ``n_best`` counts the links whose pair is the most frequent of its first id.
    ``rows`` is read twice and should be written first. A block meets its codes in one task.
    """
    need, known = pair_counts(rows)
    told = need.join(known, "code").select(F.col("block").alias("told_block"), "code", "n", "best")
    names = [c for c in rows.columns if c not in ("codes", "times")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        code = right.column("code").to_numpy()
        order = np.argsort(code)
        code, n = code[order], right.column("n").to_numpy()[order]
        best = right.column("best").to_numpy()[order].astype(np.int64)
        lists = left.column("codes").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        own = np.searchsorted(code, lists.flatten().to_numpy())
        times = left.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(size)), size)
        out = []
        for value in (best, n):
            total = np.zeros(len(size), np.int64)
            np.add.at(total, doc, times * value[own] if len(own) else times)
            out.append(total)
        return pa.table(
            {c: left.column(c) for c in names} | {"n_best": pa.array(out[0]), "count_sum": pa.array(out[1])}
        )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in names]
    return (
        rows.groupBy("block")
        .cogroup(told.groupBy("told_block"))
        .applyInArrow(run, ", ".join([*kinds, "n_best long", "count_sum long"]))
    )


def align_corpus(rows: DataFrame) -> DataFrame:
    """``scored`` of aligned rows that are written first: a text is encoded once."""
    return scored(written(rows, "aligned"))
