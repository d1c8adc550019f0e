"""Personal data by patterns and by a character-level bidirectional LSTM with a CRF.

Patterns find the plain forms. The network is trained in numpy on labelled spans: those that the
patterns find in a bounded sample, and made-up values in other spellings set into texts of the
sample. It reads all of every text in overlapping windows; emissions are averaged where windows
overlap and each text is decoded as a whole, so a span does not depend on where a window begins.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Sampled texts (whole) that the network is trained on, at most about so many.
SAMPLE_TEXTS = 500
#: Characters of a training example, of a window that is read, and what neighbours share of it.
WIDTH, WINDOW, SHARED = 64, 1024, 64
#: Windows are padded to a multiple of this, so that many of one length are read side by side.
PADDED = 256
#: Windows that are read at once, and characters of texts (at least one text) held at once.
LANES, HELD = 512, 1 << 19
HIDDEN, EMBED = 12, 8
EPOCHS, BATCH, RATE = 8, 24, 0.03
#: Characters around a drawn place of a sampled text that its training examples are cut from.
STRETCH = 4000
#: Mean margin over "no data" (log odds a character) that a span of the network needs. Most
#: characters of an address are letters as anywhere: it needs a margin as a whole, transitions too.
MARGIN, WHOLE = 2.0, 10.0

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # first character, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def patterns(text: str) -> list[Span]:
    """Spans of the patterns, leftmost and non-overlapping within each kind.

    No run of characters is scanned from more than one start, so the time is linear: a match
    that fails at the first character of its run fails at all others, too.
    """
    out: list[Span] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((begin, 0, m.end()))
            done = m.end()
        else:
            done = max(done, at)
        at = text.find("@", max(done, at + 1))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


_CODE = np.r_[1, 1:128, np.full(0x2000 - 128, 128), 129]


def codes(text: str) -> np.ndarray:
    """ASCII as it is, other letters and other characters as one code each, never 0."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CODE[np.minimum(cp, 0x2000)]


TAGS = 1 + 2 * len(KINDS)  # outside, then first and further character of each kind


def tags(n: int, spans: list[Span]) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for begin, kind, end in spans:
        if not out[begin:end].any():
            out[begin:end] = 2 + 2 * kind
            out[begin] = 1 + 2 * kind
    return out


def _squash(x: np.ndarray) -> np.ndarray:
    """Between -1 and 1, with the slope ``(1 - |y|) ** 2`` at the value y: an absolute value, a sum and a
    quotient are a fifth of a hyperbolic tangent's cost."""
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    return (1 + _squash(x)) / 2


def _gate_slope(y: np.ndarray) -> np.ndarray:
    return (1 - np.abs(2 * y - 1)) ** 2 / 2


def _slope(y: np.ndarray) -> np.ndarray:
    return (1 - np.abs(y)) ** 2


class Network:
    """Embedding, an LSTM each way, a linear layer and the transitions of a CRF."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        g = lambda *s: r.normal(0, 0.25, s)
        self.p = {"e": g(130, EMBED), "o": g(2 * HIDDEN, TAGS), "ob": np.zeros(TAGS)}
        for way in "lr":
            self.p |= {f"w{way}": g(EMBED + HIDDEN, 4 * HIDDEN), f"b{way}": np.zeros(4 * HIDDEN)}
            self.p[f"b{way}"][HIDDEN : 2 * HIDDEN] = 3.0  # remember at first
        self.p["t"] = np.zeros((TAGS, TAGS))

    def _lstm(self, x: np.ndarray, way: str):
        w, b = self.p[f"w{way}"], self.p[f"b{way}"]
        n, length, _ = x.shape
        h = c = np.zeros((n, HIDDEN), x.dtype)
        kept = []
        out = np.zeros((n, length, HIDDEN), x.dtype)
        for t in range(length):
            z = np.concatenate([x[:, t], h], 1)
            a = z @ w + b
            i, f, o = (_gate(a[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = _squash(a[:, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            tc = _squash(c)
            h = o * tc
            out[:, t] = h
            kept.append((z, i, f, o, g, before, tc))
        return out, kept

    def _lstm_back(self, d: np.ndarray, kept: list, way: str, grad: dict) -> np.ndarray:
        w = self.p[f"w{way}"]
        dx = np.zeros((*d.shape[:2], EMBED))
        dh = dc = np.zeros((d.shape[0], HIDDEN))
        for t in range(d.shape[1] - 1, -1, -1):
            z, i, f, o, g, before, tc = kept[t]
            dh = dh + d[:, t]
            dc = dc + dh * o * _slope(tc)
            gates = [dc * g * _gate_slope(i), dc * before * _gate_slope(f), dh * tc * _gate_slope(o)]
            da = np.concatenate([*gates, dc * i * _slope(g)], 1)
            grad[f"w{way}"] += z.T @ da
            grad[f"b{way}"] += da.sum(0)
            dz = da @ w.T
            dx[:, t], dh, dc = dz[:, :EMBED], dz[:, EMBED:], dc * f
        return dx

    def emissions(self, x: np.ndarray):
        """Scores of the tags of every character of windows ``x`` (windows by characters)."""
        e = self.p["e"][x]
        left, kept_left = self._lstm(e, "l")
        right, kept_right = self._lstm(e[:, ::-1], "r")
        h = np.concatenate([left, right[:, ::-1]], 2)
        return h @ self.p["o"] + self.p["ob"], (h, kept_left, kept_right)

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tags ``y``, and its gradient."""
        s, (h, kept_left, kept_right) = self.emissions(x)
        n, length, _ = s.shape
        t = self.p["t"]
        rows = np.arange(n)
        alpha = np.zeros_like(s)
        alpha[:, 0] = s[:, 0]
        for k in range(1, length):
            m = alpha[:, k - 1].max(1, keepdims=True)
            alpha[:, k] = s[:, k] + m + np.log(np.exp(alpha[:, k - 1] - m) @ np.exp(t))
        m = alpha[:, -1].max(1)
        whole = m + np.log(np.exp(alpha[:, -1] - m[:, None]).sum(1))
        gold = s[rows[:, None], np.arange(length), y].sum(1) + t[y[:, :-1], y[:, 1:]].sum(1)
        # Derivatives are marginals less the gold tags.
        beta = np.zeros((n, TAGS))
        ds = np.zeros_like(s)
        dt = np.zeros_like(t)
        ds[:, -1] = np.exp(alpha[:, -1] - whole[:, None])
        for k in range(length - 1, 0, -1):
            after = s[:, k] + beta
            pair = np.exp(alpha[:, k - 1, :, None] + t + after[:, None, :] - whole[:, None, None])
            dt += pair.sum(0)
            ds[:, k - 1] = pair.sum(2)
            m = after.max(1, keepdims=True)
            beta = m + np.log(np.exp(after - m) @ np.exp(t).T)
        ds[rows[:, None], np.arange(length), y] -= 1
        np.add.at(dt, (y[:, :-1], y[:, 1:]), -1)
        ds, dt = ds / n, dt / n
        grad = {name: np.zeros_like(v) for name, v in self.p.items()}
        grad["t"] = dt
        grad["o"] = np.einsum("nlh,nlt->ht", h, ds)
        grad["ob"] = ds.sum((0, 1))
        dh = ds @ self.p["o"].T
        de = self._lstm_back(dh[:, :, :HIDDEN], kept_left, "l", grad)
        de += self._lstm_back(dh[:, ::-1, HIDDEN:], kept_right, "r", grad)[:, ::-1]
        np.add.at(grad["e"], x, de)
        return float((whole - gold).mean()), grad

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 0) -> Network:
        """Adam with clipped gradients over shuffled batches."""
        pick = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        step = 0
        for epoch in range(EPOCHS if len(x) else 0):
            order = pick.permutation(len(x))
            rate = RATE * (1 - epoch / EPOCHS) + RATE / 20
            for lo in range(0, len(x), BATCH):
                some = order[lo : lo + BATCH]
                _, grad = self.loss(x[some], y[some])
                norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
                scale = min(1.0, 5.0 / max(norm, 1e-9))
                step += 1
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * scale * g
                    v[k] = 0.999 * v[k] + 0.001 * (scale * g) ** 2
                    fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.p[k] -= rate * fix * m[k] / (np.sqrt(v[k]) + 1e-8)
        self.p = {k: w.astype(np.float32) for k, w in self.p.items()}
        return self

    def read(self, x: np.ndarray) -> np.ndarray:
        """``emissions`` without what training needs, a column per window, as fast as numpy goes."""
        n, length = x.shape
        x = np.ascontiguousarray(x.T)
        e = np.ascontiguousarray(self.p["e"].T, np.float32)
        ways = [np.concatenate([self.p[f"w{way}"], self.p[f"b{way}"][None]]).T for way in "lr"]
        w = np.stack(ways).astype(np.float32)  # both directions go side by side
        o = np.ascontiguousarray(self.p["o"].reshape(2, HIDDEN, TAGS).transpose(0, 2, 1), np.float32)
        # Gates stand for twice their value here, and so does the output h.
        w[:, :, EMBED:-1] *= 0.5
        o = o * np.float32(0.5)
        out = np.zeros((length, TAGS, n), np.float32)
        z = np.zeros((2, EMBED + HIDDEN + 1, n), np.float32)
        z[:, -1] = 1
        left, right, h = z[0, :EMBED], z[1, :EMBED], z[:, EMBED:-1]
        c, tc, size = np.zeros((3, 2, HIDDEN, n), np.float32)
        a, sizes = np.empty((2, 2, 4 * HIDDEN, n), np.float32)
        gates, part = a[:, : 3 * HIDDEN], np.empty((2, TAGS, n), np.float32)
        i, f, u, g = (a[:, j * HIDDEN : (j + 1) * HIDDEN] for j in range(4))
        for t in range(length):
            e.take(x[t], 1, left, "clip")
            e.take(x[-1 - t], 1, right, "clip")
            np.matmul(w, z, out=a)
            np.abs(a, out=sizes)
            sizes += 1
            a /= sizes
            gates += 1
            c *= f
            i *= g
            c += i
            c *= 0.5
            np.abs(c, out=size)
            size += 1
            np.divide(c, size, out=tc)
            np.multiply(u, tc, out=h)
            np.matmul(o, h, out=part)
            out[t] += part[0]
            out[-1 - t] += part[1]
        return np.ascontiguousarray(out.transpose(2, 0, 1)) + self.p["ob"].astype(np.float32)

    def spans(self, texts: list[str]) -> list[list[Span]]:
        """Spans of every text, each read and decoded as a whole."""
        out: list[list[Span]] = []
        lo = 0
        while lo < len(texts):
            hi, size = lo + 1, len(texts[lo])
            while hi < len(texts) and size + len(texts[hi]) <= HELD:
                size += len(texts[hi])
                hi += 1
            out += self._spans(texts[lo:hi])
            lo = hi
        return out

    def _spans(self, texts: list[str]) -> list[list[Span]]:
        first = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]  # a place that is no text after each
        code = codes("\n".join(texts) + "\n")
        s = self._scores(code, [(int(a), int(b) - 1) for a, b in zip(first, first[1:])])
        s[first[1:] - 1] = np.eye(1, TAGS) * 1e7
        path = self._decode(s, first)
        out: list[list[Span]] = [[] for _ in texts]
        begins = np.flatnonzero(path % 2)  # the rest of a span without its beginning is none
        for begin, k in zip(begins.tolist(), (np.searchsorted(first, begins, "right") - 1).tolist()):
            tag = int(path[begin])
            end = begin + 1
            while path[end] == tag + 1:
                end += 1
            margin = s[np.arange(begin, end), path[begin:end]] - s[begin:end, 0]
            kind = (tag - 1) // 2
            steps = self.p["t"][np.r_[0, path[begin:end]], np.r_[path[begin:end], 0]]
            whole = margin.sum() + (steps - self.p["t"][0, 0]).sum()
            if whole >= WHOLE if kind == 0 else margin.mean() >= MARGIN:
                out[k].append((begin - int(first[k]), kind, end - int(first[k])))
        return out

    def _scores(self, code: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
        """Emissions of all places in ``parts``; a window counts less towards a shared end."""
        out = np.zeros((len(code), TAGS), np.float32)
        starts, sizes, inner, last = [], [], [], []
        for lo, hi in parts:
            at = np.arange(lo, max(hi - SHARED, lo + 1) if hi > lo else lo, WINDOW - SHARED)
            starts.append(at)
            sizes.append(np.minimum(at + WINDOW, hi) - at)
            inner.append(at > lo)
            last.append(np.arange(len(at)) == len(at) - 1)
        if not parts:
            return out
        starts, sizes, inner, last = map(np.concatenate, (starts, sizes, inner, last))
        rise = ((np.arange(SHARED, dtype=np.float32) + 0.5) / SHARED)[:, None]
        # The padding is the same for equal windows, whatever else is read with them.
        padded = -(-sizes // PADDED) * PADDED
        for length in np.unique(padded).tolist():
            same = np.flatnonzero(padded == length)
            for k in range(0, len(same), LANES):
                some = same[k : k + LANES]
                at = starts[some][:, None] + np.arange(length)
                real = np.arange(length) < sizes[some][:, None]
                scores = self.read(np.where(real, code[np.minimum(at, len(code) - 1)], 0))
                if length >= SHARED:
                    scores[inner[some], :SHARED] *= rise
                    scores[~last[some], -SHARED:] *= rise[::-1]
                for j, (a, n) in enumerate(zip(starts[some].tolist(), sizes[some].tolist())):
                    out[a : a + n] += scores[j, :n]
        return out

    def _decode(self, s: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best tags of all texts; ``first`` is where each begins.

        A run of other tags gains at most what its places and transitions gain over "outside"
        each at best, and loses what it costs to enter and to leave. Places that are in no run with a gain
        are outside in the best path for certain; the stretches between them are decoded side by side.
        """
        t = self.p["t"].astype(np.float32)
        # What follows a first character is paid on entering instead: no sum over a run changes, but
        # the best step from one place to the next is no longer one that a run takes only once.
        moved = np.zeros(TAGS, np.float32)
        head, body = np.arange(1, TAGS, 2), np.arange(2, TAGS, 2)
        moved[head] = t[head, body] - t[body, body]
        step = t + moved - moved[:, None] - t[0, 0]
        inner = step[1:, 1:].max(0)
        enter, leave = (step[0, 1:] - inner).max(), step[1:, 0].max()
        gain = (s[:, 1:] + inner).max(1).astype(np.float64) - s[:, 0]
        # Nothing is paid before a text's first place and after its last.
        gain[first[:-1]] += max((moved[1:] - inner).max() - enter, 0)
        gain[np.maximum(first[1:] - 2, 0)] += max((-moved[1:]).max() - leave, 0)
        total = np.r_[0, np.cumsum(gain)]
        # The best run through a place: the highest sum at or after it, less the lowest before.
        after = np.maximum.accumulate(total[::-1])[::-1][1:]
        sure = after - np.minimum.accumulate(total)[:-1] + enter + leave < -0.05
        path = np.zeros(len(s), np.int64)
        edge = np.flatnonzero(np.diff(np.r_[True, sure, True]))
        begin, end = edge[::2], edge[1::2]
        order = np.argsort(begin - end, kind="stable")
        begin, end = begin[order], end[order]
        size = end - begin
        # Nothing comes before a text's first place, and it ends before a place that is no text.
        enter = np.where(np.isin(begin, first)[:, None], 0, t[0])
        leave = np.where(np.isin(end + 1, first)[:, None], 0, t[:, 0])
        lo = 0
        while lo < len(begin):
            hi = min(len(begin), lo + max(1, min(4 * LANES, HELD // int(size[lo]))))
            some, n = begin[lo:hi], size[lo:hi]
            best = (s[some] + enter[lo:hi]).T
            flat, kept = best[0], []
            for k in range(int(n[0])):
                m = int(np.searchsorted(-n, -k, "left"))  # stretches of more than k places
                if k:
                    here = s[some[:m] + k].T
                    best = (best[:, None, :m] + t[:, :, None]).max(0) + here
                    flat = flat[:m] + t[0, 0] + here[0]
                kept.append(best)
                stay = int(np.searchsorted(-n[:m], -k - 1, "left"))
                final = best[:, stay:] + leave[lo + stay : lo + m].T
                # Where nothing is better than "outside" all along, that is the path.
                for j in np.flatnonzero(final.max(0) > flat[stay:] + leave[lo + stay : lo + m, 0]).tolist():
                    tag = int(final[:, j].argmax())
                    path[some[stay + j] + k] = tag
                    for back in range(k - 1, -1, -1):
                        tag = int((kept[back][:, stay + j] + t[:, tag]).argmax())
                        path[some[stay + j] + back] = tag
            lo = hi
        return path


def plausible(text: str, kind: int) -> bool:
    """What a span of the network must hold to be taken: the digits of a number, or two words, as
    any spelling of an address has, and none three times on end."""
    digits = len(_DIGIT.findall(text))
    if kind == 0:
        words = re.findall(r"[^\W_]+", text)
        return len(words) >= 2 and not any(x == y == z for x, y, z in zip(words, words[1:], words[2:]))
    if kind == 1:
        numbers = re.findall(r"[0-9]+", text)
        return len(numbers) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in numbers)
    if kind == 2:
        return 14 <= digits <= 19 and luhn(re.sub("[^0-9]", "", text))
    return 9 <= digits <= 15


def detect_all(texts: list[str | None], network: Network | None) -> list[tuple[list[Span], list[Span]]]:
    """For every text, the spans of the patterns, and all spans: those of the network that touch
    none of them too."""
    texts = [t or "" for t in texts]
    once = list(dict.fromkeys(texts))  # copies are read once
    found = network.spans(once) if network else [[] for _ in once]
    spans = {t: _joined(t, patterns(t), more) for t, more in zip(once, found, strict=True)}
    return [spans[t] for t in texts]


def _joined(text: str, base: list[Span], found: list[Span]) -> tuple[list[Span], list[Span]]:
    if not found:
        return base, base
    taken = np.zeros(len(text) + 1, bool)
    for begin, _, end in base:
        taken[begin:end] = True
    more = []
    for begin, kind, end in found:
        while end > begin and text[end - 1] in " \n\t,.;:-(":
            end -= 1
        if end > begin and not taken[begin:end].any() and plausible(text[begin:end], kind):
            taken[begin:end] = True
            more.append((begin, kind, end))
    return base, sorted([*base, *more])


def detect(text: str | None, network: Network | None) -> tuple[list[Span], list[Span]]:
    return detect_all([text], network)[0]


def _made_up(pick: random.Random, kind: int | None = None) -> tuple[str, int]:
    """A value in a spelling that the patterns may or may not know."""
    number = lambda n: "".join(pick.choice("0123456789") for _ in range(n))
    word = lambda: "".join(pick.choice("aabcdeefghiijklmnnoopqrrssttuvwxyz") for _ in range(pick.randrange(2, pick.choice([9, 9, 9, 16]))))
    kind = pick.randrange(4) if kind is None else kind
    if kind == 0:
        form = pick.choice(["@", "@", " @ ", " {} ", " {} ", " {} ", "({})", " ({}) ", " ( {} ) ", "[{}]", " [{}] ", " [ {} ] ", "{{{}}}", " {{{}}} ", " <{}> "])
        at, dot = pick.choice([("at", "dot"), ("at", "dot"), ("AT", "DOT")])
        dot = "." if "@" in form else pick.choice([".", ".", f" {dot} ", f" {dot} ", f" ({dot}) ", f"({dot})", f"[{dot}]", f" [{dot}] "])
        local = word() + pick.choice(["", number(2), "." + word(), "_" + word(), dot + word()])
        host = word() + pick.choice(["", "", "-" + word(), dot + word()])
        return local + form.format(at) + host + dot + pick.choice(["com", "org", "net", "de", "example.com"]), 0
    if kind == 1:
        dot = pick.choice([".", ".", " . ", "[.]"])
        return dot.join(str(pick.randrange(256)) for _ in range(4)), 1
    if kind == 2:
        digits = number(15)
        digits += next(d for d in "0123456789" if luhn(digits + d))
        gap = pick.choice(["", "", " ", "-", ".", "  "])
        return gap.join(digits[k : k + 4] for k in range(0, 16, 4)), 2
    form = pick.choice(["+{} ({}) {}-{}", "+{} {} {} {}", "+{}-{}-{}-{}", "({1}) {2}-{3}", "00{} {} {} {}", "{1}-{2}-{3}"])
    return form.format(pick.randrange(1, 99), number(3), number(3), number(4)), 3


def examples(texts: list[str], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags: pattern spans of the texts, made-up values in them, and other digits."""
    pick = random.Random(seed)
    x, y = [], []

    def add(text: str, spans: list[Span], at: int) -> None:
        lo = max(0, at - pick.randrange(8, WIDTH - 8))
        window = np.zeros(WIDTH, np.int64)
        some = codes(text[lo : lo + WIDTH])
        window[: len(some)] = some
        tag = np.zeros(WIDTH, np.int64)
        tag[: len(some)] = tags(len(text), spans)[lo : lo + WIDTH]
        x.append(window)
        y.append(tag)

    for text in texts:
        if len(text) > STRETCH:
            lo = pick.randrange(len(text) - STRETCH)
            text = text[lo : lo + STRETCH]
        if len(text) < 10:
            continue
        spans = patterns(text)
        for begin, _, _ in spans[:2]:
            add(text, spans, begin)
        at = text.find(" ", pick.randrange(len(text))) + 1
        for which in (None, None, 0, 3):  # addresses and numbers to call have the most spellings
            value, kind = _made_up(pick, which)
            changed = f"{text[:at]}{value} {text[at:]}"
            own = [s for s in spans if s[2] <= at]
            own += [(s[0] + len(value) + 1, s[1], s[2] + len(value) + 1) for s in spans if s[0] >= at]
            add(changed, [*own, (at, kind, at + len(value))], at)
        # Numbers and signs that are no personal data.
        for n in (pick.randrange(1, 5), pick.randrange(5, 9), pick.randrange(20, 44)):
            plain = "".join(pick.choice("0123456789" if n < 9 else "0123456789abcdef") for _ in range(n))
            plain = pick.choice(["", "No. ", "v1.", "(c) ", "$", "@", "#"]) + plain
            add(f"{text[:at]}{plain} {text[at:]}", [s for s in spans if s[2] <= at], at)
        # Words that are none either: as they stand, and with those that an address may be spelled with.
        plain = pick.choice(["at ", "At ", "dot ", "(at) ", "(dot) ", "at the ", "AT ", "[1] ", "{ } ", "( ) "])
        for changed in (text, f"{text[:at]}{plain}{text[at:]}"):
            around = changed[max(0, at - WIDTH) : at + WIDTH + len(plain)]
            if not _TRIGGER.search(around.replace(plain, "")):
                add(changed, [], at)
        if pick.random() < 0.3:
            again = (text[at:].split() or ["x"])[0][:20]
            add(f"{again} " * WIDTH, [], pick.randrange(WIDTH))
    if not x:
        return np.zeros((0, WIDTH), np.int64), np.zeros((0, WIDTH), np.int64)
    return np.array(x), np.array(y)


def fit(docs: DataFrame, text: str = "text", seed: str = "doc_id") -> Network:
    """Train the network on about ``SAMPLE_TEXTS`` texts drawn by a hash of ``seed``; without
    any texts it stays untrained and finds nothing that the patterns do not. Of each text drawn,
    ``STRETCH`` characters at a drawn place teach; texts that are searched are read whole."""
    n = docs.count()
    draw = F.pmod(F.xxhash64(F.col(seed).cast("string"), F.lit("pii")), F.lit(1 << 30))
    share = int(min(1.0, SAMPLE_TEXTS / max(n, 1)) * (1 << 30))
    # Examples are windows of some characters, so a stretch of each text is fetched, from a drawn place.
    spare = F.greatest(F.char_length(text) - STRETCH, F.lit(0))
    place = F.pmod(F.xxhash64(F.col(seed).cast("string"), F.lit("place")), spare + 1).cast("int")
    rows = docs.where(draw < share).select(F.substr(F.col(text), place + 1, F.lit(STRETCH))).toArrow()
    texts = [t for t in rows.column(0).to_pylist() if t]
    return Network().train(*examples(sorted(texts)))


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{begin}:{end}" for begin, kind, end in spans)


def find(docs: DataFrame, network: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, spans`` for every row: spans ``kind:start:end`` of the patterns, and all.

    Positions are code points of the whole text, ends excluded; spans are ordered by start,
    then by the order of ``KINDS``, and joined by commas. Spans of the patterns always stay; the
    network adds spans that touch none. A null, empty or plain text has none. Repeated rows get
    the same spans; other columns are not read; no row moves.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = detect_all(batch.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([_written(f[k]) for f in found], pa.string()) for k in (0, 1)]],
                ["doc_id", "base", "spans"],
            )

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, base string, spans string")


def redact_text(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlaps become one."""
    if not text:
        return text
    out, at = [], 0
    for begin, kind, end in spans:
        if begin >= at:
            out += [text[at:begin], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, network: Network, text: str = "text", size: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced; ``size``, if given, becomes the new text's length
    in characters (a null text keeps what it had). All other columns and rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(text).to_pylist()
            new = [redact_text(t, f[1]) for t, f in zip(old, detect_all(old, shared.value), strict=True)]
            columns = {c: batch.column(c) for c in names}
            columns[text] = pa.array(new, batch.schema.field(text).type)
            if size:
                old = columns[size].to_pylist()
                sizes = [o if t is None else len(t) for t, o in zip(new, old, strict=True)]
                columns[size] = pa.array(sizes, batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return docs.mapInArrow(run, docs.schema)
