"""Trend and seasonality of many equally long series at once, in numpy.

Used inside one Arrow UDF. Arrays have shape (periods, series); every operation is
elementwise along the series axis, so a result does not depend on which series share
a batch. Method: seasonal-trend decomposition by loess (Cleveland et al. 1990), future
trend by additive exponential smoothing chosen by AICc (Hyndman et al. 2008).
"""

from __future__ import annotations

import numpy as np

# Smoothing span of the seasonal component and number of loop passes.
SEASONAL_SPAN = 11
PASSES = 5

# Periods x series decomposed at once, series extrapolated at once: arrays of a few MB.
CELLS_AT_ONCE = 500_000
SERIES_AT_ONCE = 256
#: Periods of series that are handed over together.
PERIODS_AT_ONCE = 1 << 19


def without_gaps(y: np.ndarray) -> np.ndarray:
    """Carry the last known value over missing ones; zero before the first."""
    missing = np.isnan(y)
    if not missing.any():
        return y
    last = np.maximum.accumulate(np.where(missing, -1, np.arange(len(y))))
    return np.where(last >= 0, y[np.maximum(last, 0)], 0.0)


def _odd_at_least(x: float) -> int:
    n = int(np.ceil(x))
    return n + 1 - n % 2


def trend_span(season: int) -> int:
    return max(3, _odd_at_least(1.5 * season / (1 - 1.5 / SEASONAL_SPAN)))


def _kernel(n: int, span: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """First neighbour and weights of every position -pad .. n-1+pad."""
    width = min(span, n)
    at = np.arange(-pad, n + pad, dtype=float)
    left = np.clip(at.astype(int) - (width - 1) // 2, 0, n - width)
    reach = np.maximum(at - left, left + width - 1 - at) + max(0, (span - n) // 2)
    offset = left[:, None] + np.arange(width) - at[:, None]
    ratio = np.abs(offset) / np.maximum(reach, 1e-12)[:, None]
    weight = np.where(ratio <= 0.001, 1.0, (1 - np.minimum(ratio, 1.0) ** 3) ** 3)
    weight = np.where(ratio <= 0.999, weight, 0.0)
    weight /= weight.sum(axis=1, keepdims=True)
    centre = (weight * offset).sum(axis=1)
    spread = (weight * (offset - centre[:, None]) ** 2).sum(axis=1)
    sloped = np.sqrt(spread) > 0.001 * max(n - 1, 1)
    slope = np.where(sloped, -centre / np.where(sloped, spread, 1.0), 0.0)
    return left, weight * (1 + slope[:, None] * (offset - centre[:, None]))


def loess(y: np.ndarray, span: int, pad: int = 0) -> np.ndarray:
    """Local linear regression with tricube weights at positions -pad .. n-1+pad."""
    left, weight = _kernel(len(y), span, pad)
    weight = weight.reshape(weight.shape + (1,) * (y.ndim - 1))
    out = weight[:, 0] * y[left]
    for j in range(1, weight.shape[1]):
        out += weight[:, j] * y[left + j]
    return out


def _moving_average(y: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(y) - width + 1,) + y.shape[1:])
    for j in range(width):
        out += y[j : j + len(out)]
    return out / width


def decompose(y: np.ndarray, season: int) -> tuple[np.ndarray, np.ndarray]:
    """Trend and seasonal parts of (periods, series); no season below two full cycles."""
    n = len(y)
    if season < 2 or n < 2 * season:
        return loess(y, trend_span(max(season, 1))), np.zeros_like(y)
    trend = np.zeros_like(y)
    cycles = np.empty((n + 2 * season,) + y.shape[1:])
    # Phases 0 .. longer-1 of the cycle occur once more than the others.
    whole, longer = divmod(n, season)
    for _ in range(PASSES):
        detrended = y - trend
        for phases, count in ((range(longer), whole + 1), (range(longer, season), whole)):
            if len(phases):
                at = np.add.outer(np.arange(count) * season, phases)
                around = np.add.outer(np.arange(count + 2) * season, phases)
                cycles[around] = loess(detrended[at], SEASONAL_SPAN, pad=1)
        low = _moving_average(_moving_average(_moving_average(cycles, season), season), 3)
        seasonal = cycles[season : season + n] - loess(low, _odd_at_least(season + 1))
        trend = loess(y - seasonal, trend_span(season))
    return trend, seasonal


def _filter(y, lengths, alpha, beta, phi):
    """Run error-correction smoothing; return squared error and last level and slope.

    Columns of ``y`` are series in order of length, each from row 0; parameters are one
    row for all series or one row each. The errors are linear in the start (level,
    slope), so one run from zero and one from each unit start give the least-squares
    start in closed form. The unit runs do not depend on ``y``.
    """
    shape = (len(lengths), alpha.shape[1])
    shared = alpha.shape[0] == 1
    level, slope, s00, s01, s02 = (np.zeros(shape) for _ in range(5))
    # Level and slope from either unit start, then the sums of their error products.
    unit = [np.full(alpha.shape, v) for v in (1.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0)]
    ended = [np.empty(shape) for _ in unit] if shared else unit
    for t in range(lengths[-1]):
        first, after = np.searchsorted(lengths, [t, t + 1], side="right")
        live = slice(first, None)
        own = slice(None) if shared else live
        a, b, p = alpha[own], beta[own], phi[own]
        u = unit[0][own] + p * unit[1][own]
        v = unit[2][own] + p * unit[3][own]
        unit[0][own], unit[1][own] = u - a * u, p * unit[1][own] - b * u
        unit[2][own], unit[3][own] = v - a * v, p * unit[3][own] - b * v
        for k, product in ((4, u * u), (5, u * v), (6, v * v)):
            unit[k][own] += product
        ahead = level[live] + p * slope[live]
        e = y[t, live, None] - ahead
        level[live], slope[live] = ahead + a * e, p * slope[live] + b * e
        s00[live] += e * e
        s01[live] -= e * u
        s02[live] -= e * v
        if shared:
            for whole, now in zip(ended, unit):
                whole[first:after] = now
    s11, s12, s22 = ended[4:]
    # Without a slope (beta = phi = 0) the second start has no effect.
    det = s11 * s22 - s12 * s12
    both = det > 1e-9 * s11 * s22
    safe = np.where(both, det, 1.0)
    x = np.where(both, (s12 * s02 - s22 * s01) / safe, -s01 / s11)
    z = np.where(both, (s12 * s01 - s11 * s02) / safe, 0.0)
    sse = s00 + x * s01 + z * s02
    return (
        np.maximum(sse, 1e-18 * (1 + s00)),
        level + x * ended[0] + z * ended[2],
        slope + x * ended[1] + z * ended[3],
    )


def _grid(alphas, shares, phis):
    """Parameter triples; ``beta`` is a share of ``alpha``, ``phi = 0`` means no slope."""
    a, s, p = (g.ravel() for g in np.meshgrid(alphas, shares, phis, indexing="ij"))
    keep = (p > 0) | (s == shares[0])
    a, s, p = a[keep], s[keep], p[keep]
    return a, np.where(p > 0, s, 0.0), p


def _criterion(sse: np.ndarray, n: np.ndarray, size: np.ndarray) -> np.ndarray:
    """AICc of a model with ``size`` parameters; infinite where it has too few periods."""
    spare = n - size - 1
    score = n * np.log(sse) + 2 * size + 2 * size * (size + 1) / np.maximum(spare, 0.5)
    return np.where((size > 3) & (spare < 1), np.inf, score)


def best_smoothing(
    y: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Criterion, last level, last slope and damping of each column's best model.

    A coarse grid over all models, then three closer searches around each series' best.
    """
    n = lengths[:, None]
    alphas, shares = [0.05, 0.3, 0.65, 0.9999], [0.001, 0.25, 0.6, 0.9999]
    alpha, share, phi = (g[None, :] for g in _grid(alphas, shares, [0.0, 1.0, 0.8, 0.9, 0.98]))
    size = np.where(phi == 0, 3, np.where(phi == 1, 5, 6))
    rows = np.arange(len(lengths))
    da, ds = (d.ravel() for d in np.meshgrid([-1, 0, 1], [-1, 0, 1]))
    for reach in (0.17, 0.08, 0.04, 0.0):
        sse, level, slope = _filter(y, lengths, alpha, alpha * share, phi)
        score = _criterion(sse, n, size)
        best = np.argmin(score, axis=1)
        a, s, p, k = (np.broadcast_to(g, sse.shape)[rows, best] for g in (alpha, share, phi, size))
        if reach == 0.0:
            break
        alpha = np.clip(a[:, None] + reach * da, 0.0001, 0.9999)
        share = np.where(p[:, None] > 0, np.clip(s[:, None] + reach * ds, 0.0001, 0.9999), 0.0)
        phi, size = np.repeat(p[:, None], len(da), 1), np.repeat(k[:, None], len(da), 1)
    return score[rows, best], level[rows, best], slope[rows, best], p


def extrapolate(series: list[np.ndarray], horizon: int) -> np.ndarray:
    """Next ``horizon`` values of each series (as columns) by its best additive model.

    The series come in order of length.
    """
    lengths = np.array([len(y) for y in series])
    padded = np.zeros((lengths[-1], len(series)))
    for column, y in enumerate(series):
        padded[: len(y), column] = y
    _, level, slope, phi = best_smoothing(padded, lengths)
    damped = np.cumsum(phi[None, :] ** np.arange(1, horizon + 1)[:, None], axis=0)
    out = level + damped * np.where(phi > 0, slope, 0.0)
    # One or two values show no movement to continue.
    return np.where(lengths < 3, [y[-1] for y in series], out)


def components(
    series: list[np.ndarray], season: int, horizon: int
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Trend and seasonal parts of each series and of its next ``horizon`` periods.

    Series of one length are decomposed together, series of similar length are
    extrapolated together.
    """
    lengths = np.array([len(y) for y in series])
    order = np.argsort(lengths, kind="stable")
    trends, seasonals = [None] * len(series), [None] * len(series)
    for n in np.unique(lengths):
        members = np.flatnonzero(lengths == n)
        for chunk in _chunks(members, max(1, CELLS_AT_ONCE // int(n))):
            t, s = decompose(np.column_stack([series[i] for i in chunk]), season)
            for column, i in enumerate(chunk):
                trends[i], seasonals[i] = t[:, column], s[:, column]
    if horizon == 0:
        return trends, seasonals
    for chunk in _chunks(order, SERIES_AT_ONCE):
        future = extrapolate([trends[i] for i in chunk], horizon)
        for column, i in enumerate(chunk):
            n = lengths[i]
            cycle = season if season >= 2 and n >= 2 * season else 1
            last = seasonals[i][n - cycle + np.arange(horizon) % cycle]
            trends[i] = np.concatenate([trends[i], future[:, column]])
            seasonals[i] = np.concatenate([seasonals[i], last])
    return trends, seasonals


def in_parts(batch):
    """A sequence of arrays in parts of ``PERIODS_AT_ONCE`` values and one more array at most."""
    before = np.cumsum([len(v) for v in batch]) // PERIODS_AT_ONCE
    cuts = (np.flatnonzero(np.diff(before)) + 1).tolist()
    for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
        yield batch[lo:hi]


def _chunks(members: np.ndarray, size: int):
    return (members[i : i + size] for i in range(0, len(members), size))
