"""Language identification with interpolated Kneser-Ney character models.

Each language has a model of four characters, counted on a bounded sample of labelled texts.
The n-grams of all languages stand in one sorted array of hashes per order, with a column of
log-probabilities per language; a text goes to the language of the lowest cross-entropy per
character. A threshold per language, calibrated on texts that trial models did not count, marks
texts that fit none; the models themselves count all sampled texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.llm.textio import chunks, mix

ORDER = 4
#: Bytes of labelled text per language that a model is fitted on (expected; whole texts).
SAMPLE_BYTES = 3 << 20
#: One sampled text in so many sets the threshold, where trial models keep half of the sample.
CALIBRATION = 6
#: So many texts of every language are sampled at least, however long they are.
LEAST_TEXTS = 12
#: The threshold lies so many standard deviations above the mean cross-entropy.
DEVIATIONS = 4.0
#: Characters' worth of evidence that the confidence assumes at most.
EVIDENCE = 60
UNKNOWN = "und"

_ALPHABET: list[np.ndarray] = []


def alphabet() -> np.ndarray:
    """Lower-case letter, or a space, for every character of the basic plane."""
    if not _ALPHABET:
        table = np.full(1 << 16, 32, np.uint64)
        for c in range(1 << 16):
            if chr(c).isalpha():
                low = ord(chr(c).lower()[0])
                table[c] = low if low < 1 << 16 else c
        _ALPHABET.append(table)
    return _ALPHABET[0]


class Characters(NamedTuple):
    """Letters of a chunk, words a space apart, a space before and after each text."""

    code: np.ndarray
    doc: np.ndarray


def characters(texts: list[str]) -> Characters:
    whole = " ".join(texts)
    cp = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) + 1 for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), size)[: len(cp)]
    code = alphabet()[np.minimum(cp, 0xFFFF)]
    far = np.flatnonzero(cp > 0xFFFF)
    if len(far):
        letter = {c: 0xFFFF if chr(c).isalpha() else 32 for c in set(cp[far].tolist())}
        code[far] = [letter[c] for c in cp[far].tolist()]
    inside = code != 32
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # one space after a word
    code, doc = code[keep], doc[keep]
    return Characters(code, doc)


def grams(chars: Characters, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams ending at each character, and its text; a text begins with spaces."""
    code, doc = chars
    packed = code.copy()
    for back in range(1, n):
        before = np.full(len(code), 32, np.uint64)
        before[back:] = np.where(doc[back:] == doc[:-back], code[:-back], np.uint64(32))
        packed |= before << np.uint64(16 * back)
    return packed, doc


class Table(NamedTuple):
    """Sorted hashes of n-grams and a row of values for each."""

    keys: np.ndarray
    values: np.ndarray

    def find(self, packed: np.ndarray) -> np.ndarray:
        """Row of each n-gram, or -1."""
        if not len(self.keys):
            return np.full(len(packed), -1)
        h = mix(packed)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, at, -1)


def _table(packed: np.ndarray, values: np.ndarray) -> Table:
    keys = mix(packed)
    order = np.argsort(keys)
    return Table(keys[order], values[order].astype(np.float32))


class Models:
    """Interpolated models of several languages; ``counts`` maps packed n-grams to counts."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        raw = [counts[x] for x in self.languages]
        per_order = {ORDER: raw}
        for n in range(ORDER - 1, 0, -1):
            low = np.uint64((1 << (16 * n)) - 1)
            # How many different characters come before each n-gram.
            per_order[n] = [np.unique(g & low, return_counts=True) for g, _ in per_order[n + 1]]
        letters = max(len(np.unique(np.concatenate([g for g, _ in per_order[1]] or [[]]))), 1)
        self.floor = -math.log(letters + 1)
        self.prob: dict[int, Table] = {}
        self.back: dict[int, Table] = {}
        for n in range(1, ORDER + 1):
            self._add(n, per_order[n])
        self.limit = np.full(len(self.languages), np.inf)

    def _add(self, n: int, counted: list) -> None:
        union = np.unique(np.concatenate([g for g, _ in counted] or [np.zeros(0, np.uint64)]))
        union = union.astype(np.uint64)
        heads = np.unique(union >> np.uint64(16))
        lower = self._lower(n, union)
        prob = np.zeros((len(union), len(counted)))
        back = np.zeros((len(heads), len(counted)))
        for k, (g, c) in enumerate(counted):
            once, twice = (c == 1).sum(), (c == 2).sum()
            cut = once / (once + 2 * twice) if once else 0.5
            at = np.searchsorted(heads, g >> np.uint64(16))
            total = np.bincount(at, c, len(heads))
            kinds = np.bincount(at, minlength=len(heads))
            weight = np.where(total > 0, cut * kinds / np.maximum(total, 1), 1.0)
            back[:, k] = np.log(weight)
            own = np.zeros(len(union))
            own[np.searchsorted(union, g)] = c - cut
            head = np.searchsorted(heads, union >> np.uint64(16))
            rest = weight[head] * np.exp(lower[:, k])
            prob[:, k] = np.log(own / np.maximum(total[head], 1) + rest)
        self.back[n] = _table(heads, back)
        self.prob[n] = _table(union, prob)

    def _lower(self, n: int, packed: np.ndarray) -> np.ndarray:
        """Log-probability of the last character given one character less."""
        if n == 1:
            return np.full((len(packed), len(self.languages)), self.floor)
        return self.log_prob(n - 1, packed & np.uint64((1 << (16 * (n - 1))) - 1))

    def log_prob(self, n: int, packed: np.ndarray) -> np.ndarray:
        at = self.prob[n].find(packed)
        if len(self.prob[n].keys):
            out = self.prob[n].values[at]
        else:
            out = np.zeros((len(packed), len(self.languages)), np.float32)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            missed = packed[miss]
            head = self.back[n].find(missed >> np.uint64(16))
            weight = np.zeros((len(miss), len(self.languages)), np.float32)
            known = head >= 0
            weight[known] = self.back[n].values[head[known]]
            out[miss] = self._lower(n, missed) + weight
        return out

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean negative log-probability per character by language, and the characters."""
        chars = characters(texts)
        total = np.zeros((len(texts), len(self.languages)))
        count = np.bincount(chars.doc, minlength=len(texts)) if len(chars.doc) else np.zeros(
            len(texts), np.int64
        )
        if len(chars.code):
            packed, doc = grams(chars, ORDER)
            logs = self.log_prob(ORDER, packed)
            some = np.flatnonzero(count)
            starts = np.searchsorted(doc, some)
            total[some] = -np.add.reduceat(logs, starts, axis=0, dtype=np.float64)
        return total / np.maximum(count, 1)[:, None], count


def _text_slices(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    for chunk in chunks(column, 1 << 20):
        rows = column.slice(chunk.lo, chunk.hi - chunk.lo).to_pylist()
        yield chunk.lo, [x or "" for x in rows]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", seed: str = "doc_id") -> Models:
    """Models of all languages of ``docs``, from some ``SAMPLE_BYTES`` each, or ``LEAST_TEXTS``.

    Whole texts are drawn by a hash of ``seed`` (of the text, where that is null), those of the
    least hashes in any case, so no language is left out. A language of which too little would
    remain for trial models has no threshold: nothing that goes to it is rejected. Rows without text or language teach nothing;
    without any, the models know no language and every text is unknown.
    """
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        F.pmod(
            F.xxhash64(F.coalesce(F.col(seed).cast("string"), F.col(text)), F.lit("lang")), F.lit(1 << 30)
        ).alias("draw"),
    )
    sizes = {r[0]: r[1] for r in known.groupBy("lang").agg(F.sum(F.octet_length("text"))).collect()}
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    first = known.select("lang", "draw").withColumn("rank", rank).where(F.col("rank") <= LEAST_TEXTS)
    least = {r[0]: r[1] for r in first.groupBy("lang").agg(F.max("draw")).collect()}
    bound = F.lit(0)
    for name, size in sizes.items():
        share = int(min(1.0, SAMPLE_BYTES / max(size, 1)) * (1 << 30))
        bound = F.when(F.col("lang") == name, F.lit(max(share, least[name] + 1))).otherwise(bound)
    drawn = known.where(F.col("draw") < bound).withColumn("held", F.col("draw") % CALIBRATION == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("held").to_pylist()
            names = batch.column("lang").to_pylist()
            for lo, texts in _text_slices(batch.column("text")):
                own = list(zip(names[lo : lo + len(texts)], held[lo : lo + len(texts)], strict=True))
                for name, kept in sorted(set(own)):
                    some = [t for t, x in zip(texts, own, strict=True) if x == (name, kept)]
                    found, n = np.unique(grams(characters(some), ORDER)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n), pa.array(n * kept)],
                        ["lang", "gram", "n", "held"],
                    )

    rows = (
        drawn.select("lang", "text", "held")
        .mapInArrow(count, "lang string, gram long, n long, held long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"), F.sum("held").alias("held"))
        .toArrow()
    )
    names = rows.column("lang").to_numpy(zero_copy_only=False) if rows.num_rows else np.array([])
    gram = rows.column("gram").to_numpy().view(np.uint64)
    n = rows.column("n").to_numpy()
    held = rows.column("held").to_numpy()
    counts, fewer, calibrated = {}, {}, []
    for name in sizes:
        own = np.flatnonzero(names == name)
        own = own[np.argsort(gram[own])]
        counts[name] = fewer[name] = gram[own], n[own]
        left = n[own] - held[own]
        if 0 < held[own].sum() <= left.sum():
            fewer[name] = gram[own][left > 0], left[left > 0]
            calibrated.append(name)
    models = Models(counts)
    if not calibrated:
        return models
    shared = docs.sparkSession.sparkContext.broadcast(Models(fewer))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts in _text_slices(batch.column("text")):
                h, size = shared.value.cross_entropy(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(lo, len(texts)), pa.array(h.min(1) if h.size else []), pa.array(size)],
                    ["lang", "h", "n"],
                )

    for r in (
        drawn.where(F.col("held") & F.col("lang").isin(calibrated))
        .select("lang", "text")
        .mapInArrow(score, "lang string, h double, n long")
        .where("n >= 20")
        .groupBy("lang")
        .agg(F.avg("h").alias("mean"), F.coalesce(F.stddev("h"), F.lit(0.1)).alias("sd"))
        .collect()
    ):
        models.limit[models.languages.index(r["lang"])] = r["mean"] + DEVIATIONS * r["sd"]
    return models


def identify(
    docs: DataFrame, models: Models, doc_id: str = "doc_id", text: str = "text", reject: bool = True
) -> DataFrame:
    """One row for every row: ``doc_id, lang_pred, score, cross_entropy, rejected``.

    ``lang_pred`` is the language of the lowest cross-entropy per character, and ``und`` for a
    null text, one without a letter or, if ``reject``, one that fits no language. ``score`` is
    the confidence between 0 and 1, 0 for ``und``. Languages that tie are taken by name. Only
    the text is looked at, in full; rows do not move.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for lo, texts in _text_slices(batch.column("text")):
                n = len(texts)
                h, size = known.cross_entropy(texts)
                if not known.languages:
                    h, size = np.zeros((n, 1)), np.zeros(n)
                best = h.argmin(1)
                low = h[np.arange(n), best]
                odds = np.exp((low[:, None] - h) * np.minimum(size, EVIDENCE)[:, None])
                limit = known.limit if known.languages else np.array([np.inf])
                off = (size > 0) & (low > limit[best])
                none = (size == 0) | (off & reject)
                score = np.where(none, 0.0, 1 / odds.sum(1))
                names = [
                    UNKNOWN if x else known.languages[b] for x, b in zip(none, best, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, n),
                        pa.array(names, pa.string()),
                        pa.array(score),
                        pa.array(low),
                        pa.array(off),
                    ],
                    ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"],
                )

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean"
    )
