"""Log-likelihood of texts under a gated recurrent language model.

Texts are cut into words once, in blocks, with the distinct words of a block beside them. The counts of all
training texts give the vocabulary, its classes and the shares of rare words in their class;
they go back to the blocks by a shuffle join, so no task holds the vocabulary. A GRU predicts the
class of the next word and, for frequent words, the word in its class. It is trained in numpy by
truncated backpropagation where the data lie: in every round each task starts from the same parameters and
goes over its part of the training texts, and their results are averaged. Every training text is read
to its end, so what the network reads grows with the corpus, and its head with the
vocabulary. Texts are scored in windows with the state carried from one to the next, from end to end.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count as numbers
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandpanel.sources.checkpoints import written

#: The end of a text as a token: no word is empty.
END = b""
#: Rare words are classed by the binary logarithm of their counts; frequent ones stand in classes of
#: a fourth root of the vocabulary's size, at least PER.
PER, TAIL = 16, 48
HIDDEN = 24
#: All training texts teach the network; they are gone over until VISITS tokens have been read, once at
#: least and PASSES times at most.
VISITS, PASSES = 1 << 20, 6
#: Rounds of training, after each of which the parameters are averaged, tokens of a task, and groups
#: that results are merged in, at least.
ROUNDS, TASK_TOKENS, GROUPS = 6, 1 << 21, 16
#: A task reads so many parts of its stream side by side, at least and at most: as many as leave it UPDATES steps.
STREAMS, UPDATES, STEPS, RATE = (64, 512), 96, 24, 0.03
WINDOW, TOGETHER = 32, 512
#: Rows whose classes are scored at once, and scores whose exponentials fit in single precision, also summed.
AT_ONCE, STEEP = 1 << 11, 60.0
#: Tokens that close a block, bytes of text that are cut into words at once, words of a row.
BLOCK_TOKENS, SLICE, WORDS = 1 << 21, 1 << 20, 1 << 14
_DRAWS = 1 << 30


def _slices(data: bytes) -> Iterator[bytes]:
    """``data`` in parts of about ``SLICE`` bytes that end before white space."""
    lo = 0
    while lo < len(data):
        hi = lo + SLICE
        while hi < len(data) and data[hi] not in b" \t\n\r\v\f":
            hi += 1
        yield data[lo:hi]
        lo = hi


def tokens(text: str | None) -> Iterator[list[bytes]]:
    """Words between ASCII white space, A-Z in lower case, then the end; a long text in parts."""
    for part in _slices((text or "").encode()):
        yield part.lower().split()
    yield [END]


class Vocabulary(NamedTuple):
    """Totals of the training tokens, and the frequent words in order of frequency."""

    total: int
    distinct: int
    per: int
    head: dict[bytes, int]
    head_n: np.ndarray
    tail_total: np.ndarray  # tokens by class of rare words

    @property
    def size(self) -> int:
        """Places for frequent words; ids from here on are classes of rare words, the last unknown."""
        return 2 * self.per * self.per

    @property
    def tail(self) -> int:
        """Classes of rare words: up to the last that has any."""
        return int(np.flatnonzero(np.r_[1, self.tail_total[1:]])[-1]) + 1

    @property
    def classes(self) -> int:
        return 2 * self.per + self.tail + 1

    def ids(self, code: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Input ids of words with the place ``code`` among the frequent ones (or -1) and count ``n``."""
        tail = np.frexp(np.maximum(n, 1).astype(np.float64))[1] - 1
        rare = np.where(n > 0, self.size + np.minimum(tail, self.tail - 1), self.size + self.tail)
        return np.where(code >= 0, code, rare)

    def share(self, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Natural logarithm of a word's share of its id: 0 for frequent ones. Unseen words share the
        mass of the unknown: as many of them as were seen."""
        whole = np.log(np.r_[np.maximum(self.tail_total[: self.tail], 1), self.distinct + 1.0])
        rare = ids >= self.size
        own = np.log(np.maximum(n, 1)) - whole[np.where(rare, ids - self.size, 0)]
        return np.where(rare, own, 0.0)


def _squash(x: np.ndarray) -> np.ndarray:
    """Between -1 and 1, with the slope ``(1 - |y|) ** 2`` at the value y."""
    y = np.abs(x)
    y += 1
    return np.divide(x, y, out=y)


def _runs(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of ``group``, and where each of its values begins among them."""
    # Short integers are sorted by their digits.
    order = np.argsort(group.astype(np.uint16) if group.size and group.max() < 1 << 16 else group, kind="stable")
    return order, np.flatnonzero(np.diff(group[order], prepend=-1))


class Network:
    """A GRU over input ids, with a softmax over classes and one in each class of frequent words."""

    def __init__(self, per: int, class_bias: np.ndarray, word_bias: np.ndarray, seed: int = 0):
        self.per, self.head = per, 2 * per * per
        r = np.random.default_rng(seed)
        g = lambda *s: r.normal(0, 0.15, s)
        self.p = {
            "x": g(self.head + len(class_bias) - 2 * per, 3 * HIDDEN), "u": g(HIDDEN, 3 * HIDDEN),
            "c": np.zeros((HIDDEN, len(class_bias))), "cb": class_bias.astype(float),
            "w": np.zeros((2 * per, per, HIDDEN)), "wb": word_bias.astype(float),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def class_of(self, code: np.ndarray) -> np.ndarray:
        return np.where(code < self.head, code // self.per, code - self.head + 2 * self.per)

    def step(self, code: np.ndarray, h: np.ndarray):
        """The next state, and what backpropagation needs."""
        a, u = self.p["x"].take(code, 0), self.p["u"]
        zr = h @ u[:, : 2 * HIDDEN]
        zr += a[:, : 2 * HIDDEN]
        zr = _squash(zr)
        zr += 1
        zr *= 0.5
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = (r * h) @ u[:, 2 * HIDDEN :]
        n += a[:, 2 * HIDDEN :]
        n = _squash(n)
        after = n - h
        after *= z
        after += h
        return after, (h, zr, n)

    def log_prob(self, h: np.ndarray, code: np.ndarray, grad: dict[str, np.ndarray] | None = None):
        """Natural log-probability of each class and frequent word. Given a ``grad`` of zeros, the mean
        loss's gradient is put there, and that of ``h`` is returned as well.

        Scores stand a column a row of ``h``, as sums over columns are slow; ``AT_ONCE`` of them stay in the cache.
        Biases are the weights of a further column of ones. The largest score is taken off only where one may be
        so large that its exponential overflows.
        """
        of, n = self.class_of(code), max(len(code), 1)
        out, back = np.zeros(len(code)), None if grad is None else np.zeros_like(h)
        one = np.ones((len(code), HIDDEN + 1), h.dtype)
        one[:, :HIDDEN] = h
        classes = np.concatenate([self.p["c"].T, self.p["cb"][:, None]], 1)
        frequent = np.concatenate([self.p["w"], self.p["wb"][:, :, None]], 2)
        largest = max(np.abs(x).sum(-1).max() for x in (classes, frequent))
        steep = not largest * max(1.0, np.abs(h).max(initial=0)) < STEEP

        def add(x: np.ndarray, place: np.ndarray, weights: np.ndarray):
            s = weights @ x.T
            if steep:
                s -= s.max(0)
            own = np.arange(len(place))
            logs = s[place, own]
            np.exp(s, out=s)
            total = np.ones(len(weights), s.dtype) @ s
            logs -= np.log(total)
            if grad is None:
                return logs, None, None
            s *= 1 / (total * n)
            s[place, own] -= 1 / n
            return logs, s.T @ weights[:, :HIDDEN], s @ x

        for lo in range(0, len(code), AT_ONCE):
            some = slice(lo, lo + AT_ONCE)
            out[some], through, own = add(one[some], of[some], classes)
            if grad is not None:
                back[some] = through
                grad["c"] += own[:, :HIDDEN].T
                grad["cb"] += own[:, HIDDEN]
        words = np.flatnonzero(code < self.head)
        order, cuts = _runs(of[words])
        at = words[order]
        x, place, logs, through = one[at], code[at] % self.per, np.zeros(len(at)), np.zeros((len(at), HIDDEN), h.dtype)
        for lo, hi in zip(cuts, [*cuts[1:], len(at)]):
            k, some = of[at[lo]], slice(lo, hi)
            logs[some], found, own = add(x[some], place[some], frequent[k])
            if grad is not None:
                through[some] = found
                grad["w"][k], grad["wb"][k] = own[:, :HIDDEN], own[:, HIDDEN]
        out[at] += logs
        if grad is not None:
            back[at] += through
        return out, back

    def loss(self, code: np.ndarray, goal: np.ndarray, h: np.ndarray):
        """Mean loss over a window (streams by steps), its gradient, and the state after it.

        A goal of -1 is none.
        """
        p, u = self.p, self.p["u"]
        lanes, steps = code.shape
        states = np.empty((steps + 1, lanes, HIDDEN), h.dtype)
        zr, cand = np.empty((steps, lanes, 2 * HIDDEN), h.dtype), np.empty((steps, lanes, HIDDEN), h.dtype)
        states[0] = h
        for t in range(steps):
            states[t + 1], (_, zr[t], cand[t]) = self.step(code[:, t], states[t])
        flat, target = states[1:].reshape(-1, HIDDEN), goal.T.ravel()
        real = np.flatnonzero(target >= 0)
        n = max(len(real), 1)
        grad = {k: np.zeros_like(p[k]) for k in ("c", "cb", "w", "wb")}
        logs, back = self.log_prob(flat[real], target[real], grad)
        dh = np.zeros_like(flat)
        dh[real] = back
        dh = dh.reshape(steps, lanes, HIDDEN)
        d, inputs = np.zeros_like(h), np.empty((steps, lanes, 3 * HIDDEN), h.dtype)
        for t in range(steps - 1, -1, -1):
            before, z, r = states[t], zr[t, :, :HIDDEN], zr[t, :, HIDDEN:]
            slope = 1 - np.abs(2 * zr[t] - 1)
            slope *= slope
            slope *= 0.5
            d += dh[t]
            dn = 1 - np.abs(cand[t])
            dn *= dn
            dn *= z
            dn *= d
            through = dn @ u[:, 2 * HIDDEN :].T
            dzr = slope
            dzr[:, :HIDDEN] *= d * (cand[t] - before)
            dzr[:, HIDDEN:] *= through * before
            inputs[t, :, : 2 * HIDDEN], inputs[t, :, 2 * HIDDEN :] = dzr, dn
            d *= 1 - z
            through *= r
            d += through
            d += dzr @ u[:, : 2 * HIDDEN].T
        before, dx = states[:-1].reshape(-1, HIDDEN), inputs.reshape(-1, 3 * HIDDEN)
        reset = before * zr.reshape(-1, 2 * HIDDEN)[:, HIDDEN:]
        grad["u"] = np.concatenate([before.T @ dx[:, : 2 * HIDDEN], reset.T @ dx[:, 2 * HIDDEN :]], 1)
        # Rows of one input are added up side by side.
        own = code.T.ravel()
        order, first = _runs(own)
        grad["x"] = np.zeros_like(p["x"])
        grad["x"][own[order[first]]] = np.add.reduceat(dx[order], first)
        return -float(logs.sum()) / n, grad, states[-1]

    def train(self, stream: np.ndarray, first: int, rate: tuple[float, float] = (RATE, RATE / 10)) -> Network:
        """Adam over parallel parts of a stream of ids, windows of ``STEPS``, the rate falling from one to the
        other; the state is carried on, gradients are cut at the window's beginning."""
        lanes = min(max(STREAMS[0], len(stream) // (UPDATES * STEPS)), STREAMS[1], max(1, len(stream) // (2 * STEPS)))
        length = -(-len(stream) // lanes)
        goal = np.full(lanes * length, -1)
        goal[: len(stream)] = stream
        code = np.r_[first, np.maximum(goal[:-1], 0)].reshape(lanes, length)
        goal = goal.reshape(lanes, length)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        h = np.zeros((lanes, HIDDEN), np.float32)
        last = -(-length // STEPS)
        for step in range(1, last + 1):
            lo = (step - 1) * STEPS
            _, grad, h = self.loss(code[:, lo : lo + STEPS], goal[:, lo : lo + STEPS], h)
            now = rate[0] + (rate[1] - rate[0]) * step / last
            fix = math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            norm = math.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            clip = min(1.0, 1.0 / max(norm, 1e-9))
            for name, g in grad.items():
                g *= clip
                m[name] += (g - m[name]) * 0.1
                g *= g
                v[name] += (g - v[name]) * 0.001
                self.p[name] -= (now * fix) * m[name] / (np.sqrt(v[name]) + 1e-8)
        return self

    def score(self, texts: list[np.ndarray], first: int) -> np.ndarray:
        """Summed natural log-probability of the ids of every text, read after ``first``."""
        out = np.zeros(len(texts))
        size = np.array([len(t) for t in texts])
        order = np.argsort(-size, kind="stable")
        for lo in range(0, len(order), TOGETHER):
            some = order[lo : lo + TOGETHER]
            flat = np.concatenate([texts[i] for i in some.tolist()])
            start = np.cumsum(size[some]) - size[some]
            h = np.zeros((len(some), HIDDEN), np.float32)
            last = np.full(len(some), first)
            for at in range(0, int(size[some[0]]), WINDOW):
                active = int((size[some] > at).sum())  # longest first
                some, start, h, last = some[:active], start[:active], h[:active], last[:active]
                steps = np.arange(at, min(at + WINDOW, int(size[some[0]])))[:, None]
                there = steps < size[some]
                goal = flat[np.where(there, start + steps, 0)]
                states = np.empty((len(steps), active, HIDDEN), np.float32)
                for t in range(len(steps)):
                    states[t] = h = self.step(last, h)[0]
                    last = goal[t]
                place = np.flatnonzero(there)
                logs, _ = self.log_prob(states.reshape(-1, HIDDEN)[place], goal.ravel()[place])
                out[some] += np.bincount(place % active, logs, active)
        return out

    def packed(self) -> bytes:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)]).astype(np.float32).tobytes()

    def unpacked(self, data: np.ndarray) -> Network:
        at = 0
        for k in sorted(self.p):
            size = self.p[k].size
            self.p[k] = data[at : at + size].astype(np.float32).reshape(self.p[k].shape)
            at += size
        return self


class Model(NamedTuple):
    vocabulary: Vocabulary
    network: Network


SPLIT = (
    "block long, teaches boolean, draw int, ids array<int>, at int, words array<binary>, counts array<long>"
)


def split(docs: DataFrame, teaches: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts as places in the list of their block's words, and those lists; written.

    A row of a text has ``doc_id, block, teaches, draw`` (evenly from 0 to 2 ** 30) and ``ids``; a
    row of words has ``block, at`` (the first word's place), ``words`` and their ``counts`` in the texts that
    teach. Blocks hold ``BLOCK_TOKENS`` tokens, or one longer text.
    """
    source = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.coalesce(teaches, F.lit(False)).alias("teaches"),
        F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.col(text)), F.lit(_DRAWS)).cast("int").alias("draw"),
    )
    kind = source.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, {SPLIT}"
    names = ["doc_id", *[c.split()[0] for c in SPLIT.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        place: defaultdict[bytes, int] = defaultdict(numbers().__next__)
        n, held = np.zeros(0, np.int64), 0

        def listed(doc_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            words = list(place)
            for lo in range(0, len(words), WORDS):
                some = words[lo : lo + WORDS]
                rows = [
                    pa.nulls(1, doc_type), pa.array([block]), pa.nulls(1, pa.bool_()), pa.nulls(1, pa.int32()),
                    pa.nulls(1, pa.list_(pa.int32())), pa.array([lo], pa.int32()),
                    pa.array([some], pa.list_(pa.binary())), pa.array([n[lo : lo + WORDS]], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(rows, names)

        doc_type = None
        for batch in batches:
            doc_type = batch.column("doc_id").type
            texts, marks = batch.column("text").to_pylist(), batch.column("teaches").to_pylist()
            lo = 0
            while lo < len(texts):
                ids, size, hi = [], 0, lo
                while hi < len(texts) and size < 4 * WORDS:
                    parts = [np.fromiter(map(place.__getitem__, p), np.int32, len(p)) for p in tokens(texts[hi])]
                    own = np.concatenate(parts)
                    ids.append(own)
                    size += len(own)
                    hi += 1
                n = np.r_[n, np.zeros(len(place) - len(n), np.int64)]
                teach = [x for x, mark in zip(ids, marks[lo:hi], strict=True) if mark]
                if teach:
                    n += np.bincount(np.concatenate(teach), minlength=len(n))
                offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
                rows = [
                    batch.column("doc_id").slice(lo, hi - lo), pa.array([block] * (hi - lo)),
                    batch.column("teaches").slice(lo, hi - lo), batch.column("draw").slice(lo, hi - lo),
                    pa.ListArray.from_arrays(offsets, np.concatenate(ids)), pa.nulls(hi - lo, pa.int32()),
                    pa.nulls(hi - lo, pa.list_(pa.binary())), pa.nulls(hi - lo, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(rows, names)
                held += size
                lo = hi
                if held >= BLOCK_TOKENS:
                    yield from listed(doc_type)
                    block, held = block + 1, 0
                    place.clear()
                    place.default_factory = numbers().__next__
                    n = np.zeros(0, np.int64)
        if place:
            yield from listed(doc_type)

    return written(source.mapInArrow(run, schema), "tokens")


def _words(parts: DataFrame) -> DataFrame:
    """``block, at, word, n``: each distinct word of a block, its place and training count there."""
    lists = parts.where("words IS NOT NULL")
    pair = F.posexplode(F.arrays_zip("words", "counts")).alias("k", "pair")
    return lists.select("block", F.col("at").alias("low"), pair).select(
        "block", (F.col("low") + F.col("k")).alias("at"), F.col("pair.words").alias("word"), F.col("pair.counts").alias("n")
    )


def count_words(parts: DataFrame) -> DataFrame:
    """``word, n``: the tokens of all training texts, one row a block and word being shuffled; written."""
    seen = _words(parts).where("n > 0")
    return written(seen.groupBy("word").agg(F.sum("n").alias("n")), "words")


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, frequent words and the mass of each class of rare ones.

    The driver gets as many words as the head has places: twice the root of the number of words.
    """
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    per = max(PER, math.ceil(distinct**0.25))
    top = [(bytes(r["word"]), r["n"]) for r in counts.orderBy(F.desc("n"), "word").limit(2 * per * per).collect()]
    if top and END not in dict(top):  # texts longer than the frequent words are many
        end = counts.where(F.col("word") == F.lit(END)).first()
        top[-1] = (END, end["n"] if end else 0)
    head_n = np.zeros(2 * per * per)
    head_n[: len(top)] = [n for _, n in top]
    tail = F.least(F.floor(F.log2(F.col("n").cast("double")) + 1e-9), F.lit(TAIL - 1))
    by_class = counts.groupBy(tail.alias("k")).agg(F.sum("n").alias("n")).collect()
    tail_total = np.zeros(TAIL)
    for r in by_class:
        tail_total[int(r["k"])] = r["n"]
    for _, n in top:  # those are no rare words
        if n:
            tail_total[min(int(math.log2(n) + 1e-9), TAIL - 1)] -= n
    head = {w: k for k, (w, _) in enumerate(top)}
    return Vocabulary(int(total), int(distinct), per, head, head_n, np.maximum(tail_total, 0))


CODED = "teaches boolean, draw int, n_tokens long, n_known long, base_score double, shares double, codes array<int>"


def coded(parts: DataFrame, counts: DataFrame, words: Vocabulary) -> DataFrame:
    """Every text with its input ids and what follows from counts alone; written.

    ``base_score``: decadic log-probability under add-one counts; ``shares``: natural logarithm of
    the shares of rare words in their class. ``codes`` are twice the id, plus one where the id would be
    another if the token at hand had not been counted: so unknown words occur in training
    as often as they will in other texts. A block meets its words in one task.
    """
    spark = parts.sparkSession
    head = spark.createDataFrame([(bytearray(w), k) for w, k in words.head.items()], "word binary, code int")
    # As many rows as the head has places: twice the root of the number of words.
    known = counts.join(F.broadcast(head), "word", "left")
    looked = _words(parts).select("block", "at", "word").join(known, "word").select(
        F.col("block").alias("told"), "at", "n", F.coalesce("code", F.lit(-1)).alias("code")
    )
    texts = parts.where("words IS NULL").select("doc_id", "block", "teaches", "draw", "ids")
    kind = texts.schema["doc_id"].dataType.simpleString()
    below = math.log(words.total + words.distinct + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = left.column("ids").combine_chunks()
        ids = lists.flatten().to_numpy()
        at = right.column("at").to_numpy()
        size = 1 + max(int(x.max()) if len(x) else 0 for x in (ids, at))
        n, code = np.zeros(size, np.int64), np.full(size, -1)
        n[at], code[at] = right.column("n").to_numpy(), right.column("code").to_numpy()
        own = words.ids(code, n)
        flag = own != words.ids(code, n - 1)
        offsets = lists.offsets.to_numpy()
        start = offsets[:-1] - offsets[0]
        summed = lambda by_word: np.add.reduceat(by_word[ids], start)  # noqa: E731  no text is without its end
        n_tokens = np.diff(offsets)
        base = (summed(np.log(n + 1.0)) - n_tokens * below) / math.log(10)
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "teaches": left.column("teaches"),
                "draw": left.column("draw"),
                "n_tokens": pa.array(n_tokens.astype(np.int64)),
                "n_known": pa.array(summed((n > 0).astype(np.int64))),
                "base_score": pa.array(base),
                "shares": pa.array(summed(words.share(own, n))),
                "codes": pa.ListArray.from_arrays(
                    (offsets - offsets[0]).astype(np.int32), (2 * own + flag).astype(np.int32)[ids]
                ),
            }
        )

    both = texts.groupBy("block").cogroup(looked.groupBy("told"))
    return written(both.applyInArrow(run, f"doc_id {kind}, {CODED}"), "coded")


def untrained(words: Vocabulary) -> Network:
    """A network that knows the shares of classes and of frequent words in theirs."""
    n = words.head_n.reshape(2 * words.per, words.per) + 0.5
    mass = np.r_[n.sum(1), words.tail_total[: words.tail] + 0.5, 1.0]
    mass[-1] = max(mass[2 * words.per], 1.0)  # words seen once: as many tokens were new
    return Network(words.per, np.log(mass / mass.sum()), np.log(n / n.sum(1, keepdims=True)))


def train(texts: DataFrame, words: Vocabulary) -> Network:
    """A network trained on all the ``coded`` training texts.

    Each round goes over one part of them, drawn by a hash: a task reads its texts as one stream from
    the common parameters, and the results are averaged by tokens read. The texts are not shuffled. Partial
    sums of parameters are merged in groups, so the driver gets a root of the number of tasks.
    """
    network = untrained(words)
    if not words.total:
        return network  # nothing to learn from: the classes are all that is known
    passes = min(PASSES, math.ceil(VISITS / words.total))
    parts = -(-ROUNDS // passes)
    tasks = max(1, words.total // (parts * TASK_TOKENS))
    groups = max(GROUPS, math.isqrt(tasks))
    first = words.head.get(END, words.size + words.tail)
    shared = texts.sparkSession.sparkContext
    rounds = passes * parts
    for k in range(rounds):
        now = shared.broadcast(network)
        rate = tuple(RATE * (1 - x / rounds) + RATE / 20 for x in (k, k + 1))

        def learn(batches: Iterator[pa.RecordBatch], now=now, rate=rate) -> Iterator[pa.RecordBatch]:
            streams = []
            for batch in batches:
                codes = batch.column("codes").flatten().to_numpy()
                ids = codes >> 1
                streams.append(np.where(codes & 1, _without(ids, words), ids))
            if not streams:
                return
            stream = np.concatenate(streams)
            own = Network(words.per, np.zeros(words.classes), np.zeros((2 * words.per, words.per)))
            own.unpacked(np.frombuffer(now.value.packed(), np.float32)).train(stream, first, rate)
            group = TaskContext.get().partitionId() % groups
            yield pa.RecordBatch.from_arrays(
                [pa.array([group]), pa.array([len(stream)]), pa.array([own.packed()], pa.binary())],
                ["part", "n", "mean"],
            )

        def merged(rows: pa.Table) -> pa.Table:
            total, mean = _averaged(zip(rows.column("n"), rows.column("mean")))
            return pa.table({"n": [total], "mean": pa.array([mean.tobytes()], pa.binary())})

        turn = texts.where(F.col("teaches") & (F.floor(F.col("draw") / _DRAWS * parts) == k % parts))
        dealt = turn.select("codes", "draw").coalesce(tasks).sortWithinPartitions("draw", F.size("codes"))
        learned = dealt.select("codes").mapInArrow(learn, "part long, n long, mean binary")
        found = learned.groupBy("part").applyInArrow(merged, "n long, mean binary").toArrow()
        if found.num_rows:
            network = network.unpacked(_averaged(zip(found.column("n"), found.column("mean")))[1])
    return network


def _averaged(found) -> tuple[int, np.ndarray]:
    """Total weight and mean of pairs of a weight and packed parameters, one after another."""
    total, mean = 0, np.zeros(1)
    for n, packed in found:
        total += n.as_py()
        mean = mean + (np.frombuffer(packed.as_buffer(), np.float32) - mean) * (n.as_py() / total)
    return total, mean.astype(np.float32)


def _without(ids: np.ndarray, words: Vocabulary) -> np.ndarray:
    """The class below: that of a word whose count is one less; of one seen once, the unknown."""
    return np.where(ids == words.size, words.size + words.tail, ids - 1)


def scored(texts: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of ``coded`` texts; no row moves."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    kind = texts.schema["doc_id"].dataType.simpleString()
    kept = ["doc_id", "n_tokens", "n_known", "base_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, network = shared.value
        first = words.head.get(END, words.size + words.tail)
        for batch in batches:
            lists = batch.column("codes")
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            ids = lists.flatten().to_numpy() >> 1
            found = network.score([ids[a:b] for a, b in zip(offsets, offsets[1:])], first)
            score = (found + batch.column("shares").to_numpy()) / math.log(10)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(score)], [*kept, "score"])

    return texts.select(*kept, "shares", "codes").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double"
    )


def learn_and_score(
    docs: DataFrame, teaches: Column, doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, Model]:
    """``doc_id, n_tokens, n_known, base_score, score`` for every row, and the model.

    The model learns from the rows where ``teaches`` holds. ``base_score`` is the decadic
    log-probability of the tokens under add-one counts, ``score`` that under the network. A word not
    seen in training is one of as many unseen words as there are seen ones, which share the probability
    of the unknown. A null or empty text is its end alone; repeated rows, and rows of one id or none,
    are texts of their own; other columns are not read. Without training texts nothing is known
    and all words are unseen ones. Texts are read whole, also very long ones: a text's tokens (4 bytes each) must fit
    in a task.
    """
    parts = split(docs, teaches, doc_id, text)
    counts = count_words(parts)
    words = vocabulary(counts)
    texts = coded(parts, counts, words)
    model = Model(words, train(texts, words))
    return scored(texts, model), model
