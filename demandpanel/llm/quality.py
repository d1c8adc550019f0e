"""Quality classifier from weak labels.

Heuristic labellers vote on every text or abstain. Expectation-maximisation over the counts of
all vote patterns estimates how often each labeller is right, and gives every pattern a
posterior. A linear scorer on hashed byte n-grams and binned statistics learns the posteriors of
a bounded sample, and decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.llm.textio import Chunk, chunks, mix, words

#: Bytes of text (expected; whole texts) that the scorer is trained on.
SAMPLE_BYTES = 6 << 20
BINS = 1 << 15
GRAM = 3
EPOCHS, RATE, DECAY = 150, 0.05, 1e-4

#: Statistic, then bounds: at most the first votes good, at least the second votes bad.
LABELLERS = (
    ("symbols", 0.45, 0.9),  # ASCII signs per word
    ("capitals", 0.2, 0.5),  # of all ASCII letters
    ("repeats", 0.05, 0.25),  # words equal to the word before
    ("sameness", 0.6, 0.85),  # words that came before in the text
    ("bars", 0.02, 0.2),  # "|" per word
    ("unended", 0.97, 0.9995),  # words not followed by a full stop
    ("signed", 0.25, 0.5),  # words followed by a sign that is no mark of prose
)
#: Texts of fewer words are too short for these.
LONG_ENOUGH = {
    "symbols": 10, "capitals": 5, "repeats": 10, "sameness": 200, "bars": 2, "unended": 30,
    "signed": 10,
}
#: A text of fewer n-grams shows less of itself: its frequencies are of so many.
LEAST_GRAMS = 100

_PROSE = np.zeros(256, bool)
_PROSE[list(b"\t\n\r .,;:'\"()-")] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """A column of statistics per labeller, and the number of words, for every text."""
    n = chunk.hi - chunk.lo
    w = words(chunk)
    count = np.bincount(w.doc, minlength=n) if len(w.doc) else np.zeros(n, np.int64)
    per = np.maximum(count, 1)
    data, at = chunk.data, chunk.offsets
    upper = _per_text((data >= 65) & (data <= 90), at)
    letters = np.maximum(upper + _per_text((data >= 97) & (data <= 122), at), 1)
    again = np.zeros(len(w.doc), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    repeats = np.bincount(w.doc, again, n) if len(w.doc) else np.zeros(n)
    own = mix(w.hash ^ (w.doc.astype(np.uint64) << np.uint64(40)))
    order = np.lexsort((own, w.doc))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (own[order][1:] != own[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
    kinds = np.bincount(w.doc[order], fresh, n) if len(order) else np.zeros(n)
    last = at[1:][w.doc] if len(w.doc) else w.end
    follow = np.where(w.end < last, data[np.minimum(w.end, max(len(data) - 1, 0))] if len(data) else 0, 32)
    stops = np.bincount(w.doc, follow == 46, n) if len(w.doc) else np.zeros(n)
    signed = np.bincount(w.doc, ~_PROSE[follow] & (follow < 128), n) if len(w.doc) else np.zeros(n)
    table = {
        "symbols": _per_text(_SIGN[data], at) / per,
        "capitals": upper / letters,
        "repeats": repeats / per,
        "sameness": 1 - kinds / per,
        "bars": _per_text(data == 124, at) / per,
        "unended": 1 - stops / per,
        "signed": signed / per,
    }
    return np.stack([table[name] for name, _, _ in LABELLERS], 1), count


def votes(stats: np.ndarray, count: np.ndarray) -> np.ndarray:
    """1 good, 0 bad, -1 no vote; a text without words is bad to every labeller."""
    out = np.full(stats.shape, -1, np.int8)
    for k, (name, good, bad) in enumerate(LABELLERS):
        enough = count >= LONG_ENOUGH.get(name, 1)
        out[enough & (stats[:, k] <= good), k] = 1
        out[enough & (stats[:, k] >= bad), k] = 0
    out[count == 0] = 0
    return out


class LabelModel(NamedTuple):
    """Share of good texts, and how each labeller votes on bad and good ones."""

    good: float
    table: np.ndarray  # labeller, class (bad, good), vote (none, bad, good); none tells nothing

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good for each row of votes."""
        logs = np.log(np.array([1 - self.good, self.good]))[:, None] + sum(
            np.log(self.table[k][:, patterns[:, k] + 1]) for k in range(patterns.shape[1])
        )
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over vote patterns and how many texts have each.

    It starts from the share of votes and keeps a labeller from being taken for the opposite of
    itself by a prior of a few votes.
    """
    cast = (patterns >= 0).sum(1)
    # One firm vote against is more telling than many in favour: labellers look for faults.
    good = np.where((patterns == 0).any(1), 0.1, np.where(cast > 0, 0.95, 0.5))
    model = LabelModel(0.5, np.zeros((patterns.shape[1], 2, 3)))
    prior = np.array([[0.0, 3.0, 1.0], [0.0, 1.0, 3.0]])
    for _ in range(rounds):
        mass = np.stack([counts * (1 - good), counts * good])
        table = np.stack(
            [
                np.stack([np.bincount(patterns[:, k] + 1, m, 3) for m in mass]) + prior
                for k in range(patterns.shape[1])
            ]
        )
        table /= table[:, :, 1:].sum(2, keepdims=True)
        table[:, :, 0] = 1.0
        share = (mass[1].sum() + 1) / (counts.sum() + 2)
        model = LabelModel(float(share), table)
        good = model.posterior(patterns)
    return model


def features(chunk: Chunk, stats: np.ndarray, count: np.ndarray):
    """Row, bin and weight of the hashed features of every text.

    The frequencies of byte n-grams share half of the weight, binned statistics the rest.
    """
    n, at = chunk.hi - chunk.lo, chunk.offsets
    data = chunk.data.astype(np.uint32)
    size = max(len(data) - GRAM + 1, 0)
    code = np.zeros(size, np.uint32)
    for k in range(GRAM):
        code = (code << np.uint32(8)) | data[k : k + size]
    bins = (code * np.uint32(2654435761)) >> np.uint32(17)
    row = np.repeat(np.arange(n), np.diff(at))[:size]
    inside = np.arange(size) + GRAM <= at[1:][row] if size else np.zeros(0, bool)
    row, bins = row[inside], bins[inside]
    per = np.maximum(np.bincount(row, minlength=n), LEAST_GRAMS) if len(row) else np.ones(n)
    rows, all_bins, weight = [row], [bins.astype(np.int64)], [1.0 / per[row] if len(row) else np.zeros(0)]
    for k, (name, good, bad) in enumerate(LABELLERS):
        step = np.digitize(stats[:, k], [good, (good + bad) / 2, bad])
        step = np.where(count >= LONG_ENOUGH.get(name, 1), step, 4)
        rows.append(np.arange(n))
        all_bins.append((mix((step + 8 * k).astype(np.uint64)) % np.uint64(BINS)).astype(np.int64))
        weight.append(np.full(n, 0.3))
    return np.concatenate(rows), np.concatenate(all_bins), np.concatenate(weight)


class Scorer(NamedTuple):
    weight: np.ndarray
    bias: float

    def score(self, n: int, row: np.ndarray, bins: np.ndarray, weight: np.ndarray) -> np.ndarray:
        z = np.bincount(row, self.weight[bins] * weight, n) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _merged(row: np.ndarray, bins: np.ndarray, weight: np.ndarray):
    """Entries of one text and bin as one, in small types: the driver holds those of a sample."""
    at, which = np.unique(row * BINS + bins, return_inverse=True)
    return (at // BINS).astype(np.int32), (at % BINS).astype(np.uint16), np.bincount(which, weight)


def fit_scorer(parts: list[tuple], target: np.ndarray) -> Scorer:
    """Logistic regression on soft targets by Adam, whole batches, both classes weighted alike.

    ``parts`` are ``(first text, text after the last, row, bins, weight)``, rows counted from
    the first; every step goes through them one by one.
    """
    n = len(target)
    balance = np.where(target > 0.5, 0.5 / max(target.mean(), 1e-3), 0.5 / max(1 - target.mean(), 1e-3))
    balance /= balance.mean()
    w, bias = np.zeros(BINS), 0.0
    m, v, mb, vb = np.zeros(BINS), np.zeros(BINS), 0.0, 0.0
    for t in range(1, EPOCHS + 1):
        g, gb = DECAY * w, 0.0
        for lo, hi, row, bins, weight in parts:
            error = Scorer(w, bias).score(hi - lo, row, bins, weight) - target[lo:hi]
            error *= balance[lo:hi] / n
            g += np.bincount(bins, error[row] * weight, BINS)
            gb += error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix = np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w = w - RATE * fix * m / (np.sqrt(v) + 1e-9)
        bias -= RATE * fix * mb / (vb**0.5 + 1e-9)
    return Scorer(w.astype(np.float32), float(bias))


class Model(NamedTuple):
    labels: LabelModel
    scorer: Scorer | None  # of an empty sample: the labels decide


def fit(docs: DataFrame, text: str = "text", seed: str = "doc_id") -> Model:
    """Count the vote patterns of all texts, then train the scorer on a bounded sample.

    The sample is some ``SAMPLE_BYTES`` of whole texts, drawn by a hash of ``seed``. Where no
    text is drawn, there is no scorer, and the posterior of a text's votes decides.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                v = votes(*statistics(chunk)).astype(np.int64) + 1
                code = v @ 3 ** np.arange(v.shape[1])
                kinds, n = np.unique(code, return_counts=True)
                size = np.bincount(np.searchsorted(kinds, code), np.diff(chunk.offsets), len(kinds))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds), pa.array(n), pa.array(size.astype(np.int64))],
                    ["pattern", "n", "bytes"],
                )

    texts = docs.select(F.col(text).alias("text"))
    counted = (
        texts.mapInArrow(vote, "pattern long, n long, bytes long")
        .groupBy("pattern")
        .agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
        .collect()
    )
    k = np.arange(len(LABELLERS))
    patterns = np.array([[r["pattern"] // 3**j % 3 - 1 for j in k] for r in counted], np.int64)
    patterns = patterns.reshape(len(counted), len(LABELLERS))
    labels = fit_labels(patterns, np.array([r["n"] for r in counted], float))
    share = min(1.0, SAMPLE_BYTES / max(sum(r["bytes"] for r in counted), 1))
    draw = F.pmod(F.xxhash64(F.col(seed).cast("string"), F.lit("quality")), F.lit(1 << 30))
    sample = docs.where(draw < int(share * (1 << 30))).select(F.col(text).alias("text")).toArrow()
    n, parts, targets = 0, [], []
    for chunk in chunks(sample.column("text").combine_chunks()):
        stats, count = statistics(chunk)
        hi = n + chunk.hi - chunk.lo
        parts.append((n, hi, *_merged(*features(chunk, stats, count))))
        targets.append(labels.posterior(votes(stats, count).astype(np.int64)))
        n = hi
    if not n:
        return Model(labels, None)
    return Model(labels, fit_scorer(parts, np.concatenate(targets)))


def _scored(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    scores, posteriors = [np.zeros(0)], [np.zeros(0)]
    for chunk in chunks(column):
        stats, count = statistics(chunk)
        some = posterior = model.labels.posterior(votes(stats, count).astype(np.int64))
        if model.scorer:
            some = model.scorer.score(chunk.hi - chunk.lo, *features(chunk, stats, count))
        scores.append(np.where(count > 0, some, 0.0))
        posteriors.append(posterior)
    return np.concatenate(scores), np.concatenate(posteriors)


def classify(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", least: float = 0.5
) -> DataFrame:
    """``doc_id, score, posterior, accepted`` for every row.

    A text is accepted if the scorer gives it ``least`` or more; a null, empty or wordless text
    has score 0. Repeated rows get the same result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, posterior = _scored(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array(posterior), pa.array(score >= least)],
                ["doc_id", "score", "posterior", "accepted"],
            )

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, score double, posterior double, accepted boolean")


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose text is rejected; all columns stay, no row moves."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, _ = _scored(shared.value, batch.column(text))
            yield batch.filter(pa.array(score >= least))

    return docs.mapInArrow(run, docs.schema)
