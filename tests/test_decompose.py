from __future__ import annotations

import datetime

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandpanel.functions import smoothing
from demandpanel.operators import decompose
from demandpanel.operators.calendar import future_calendar
from demandpanel.plans import pipeline
from registry import queries


def naive_loess(y, span, at):
    """Weighted least squares at one place, from the definition."""
    n, width = len(y), min(span, len(y))
    order = np.argsort(np.abs(np.arange(n) - at), kind="stable")[:width]
    order = np.sort(order)
    reach = max(at - order[0], order[-1] - at) + max(0, (span - n) // 2)
    weight = (1 - (np.abs(order - at) / reach) ** 3) ** 3
    weight = np.where(np.abs(order - at) <= 0.999 * reach, weight, 0)
    design = np.column_stack([np.ones(width), order - at])
    root = np.sqrt(weight)
    return np.linalg.lstsq(design * root[:, None], y[order] * root, rcond=None)[0][0]


@pytest.mark.parametrize("n, span", [(40, 7), (40, 23), (9, 11), (13, 13), (12, 31)])
def test_loess_equals_its_definition(n, span):
    y = np.random.default_rng(n + span).normal(size=(n, 2))
    got = smoothing.loess(y, span, pad=1)
    for row, at in enumerate(range(-1, n + 1)):
        for series in range(2):
            assert got[row, series] == pytest.approx(naive_loess(y[:, series], span, at), abs=1e-9)


def test_a_line_has_no_season():
    (trend,), (seasonal,) = smoothing.components([3 + 2 * np.arange(40.0)], 12, 4)
    assert trend == pytest.approx(3 + 2 * np.arange(44.0), abs=1e-6)
    assert np.abs(seasonal).max() < 1e-9


def test_known_season_is_found():
    t = np.arange(96)
    wave = 10 * np.sin(2 * np.pi * t / 12)
    (trend,), (seasonal,) = smoothing.components([50 + 0.5 * t + wave], 12, 12)
    assert seasonal[:96] == pytest.approx(wave, abs=0.2)
    assert trend[12:84] == pytest.approx((50 + 0.5 * t)[12:84], abs=0.2)
    assert seasonal[96:] == pytest.approx(seasonal[84:96])
    assert trend[96:] == pytest.approx(50 + 0.5 * np.arange(96, 108), abs=1.0)


@settings(max_examples=40, deadline=None)
@given(
    st.lists(st.integers(1, 60), min_size=1, max_size=5),
    st.integers(1, 14),
    st.integers(0, 5),
    st.integers(0, 10**6),
)
def test_any_series_gives_finite_parts_whatever_the_batch(lengths, season, horizon, seed):
    rng = np.random.default_rng(seed)
    series = [rng.normal(size=n) * rng.choice([0.0, 1.0, 1e6]) for n in lengths]
    trends, seasonals = smoothing.components(series, season, horizon)
    for y, trend, seasonal in zip(series, trends, seasonals):
        assert len(trend) == len(seasonal) == len(y) + horizon
        assert np.isfinite(trend).all() and np.isfinite(seasonal).all()
        if season < 2 or len(y) < 2 * season:
            assert not seasonal.any()
        (alone,), (alone_seasonal,) = smoothing.components([y], season, horizon)
        assert np.array_equal(alone, trend) and np.array_equal(alone_seasonal, seasonal)


def recursion(y, alpha, beta, phi, level, slope):
    """Squared error of one model, written out."""
    sse = 0.0
    for v in y:
        ahead = level + phi * slope
        sse, level, slope = sse + (v - ahead) ** 2, ahead + alpha * (v - ahead), phi * slope + beta * (v - ahead)
    return sse


def test_start_values_minimise_the_squared_error():
    y = np.cumsum(np.random.default_rng(1).normal(0.2, 1, size=30))
    for alpha, beta, phi in [(0.4, 0.1, 1.0), (0.7, 0.3, 0.9), (0.5, 0.0, 0.0)]:
        args = [np.array([[v]]) for v in (alpha, beta, phi)]
        got = smoothing._filter(y[:, None], np.array([30]), *args)[0][0, 0]
        tries = [
            recursion(y, alpha, beta, phi, a, b)
            for a in np.linspace(y[0] - 4, y[0] + 4, 161)
            for b in (np.linspace(-2, 2, 81) if phi else [0.0])
        ]
        assert got <= min(tries) and got == pytest.approx(min(tries), rel=0.01)


def test_search_finds_the_best_model():
    """Against a dense grid over the same models, by the same criterion."""
    rng = np.random.default_rng(3)
    mesh = np.meshgrid(np.linspace(0.005, 0.9999, 120), np.linspace(0.0005, 0.9999, 60))
    alpha, share = (g.ravel()[None, :] for g in mesh)
    for drift, noise in [(0.3, 1.0), (0.0, 3.0), (1.0, 0.1)]:
        y = np.cumsum(rng.normal(drift, 1, size=(50, 1)), axis=0) + rng.normal(0, noise, (50, 1))
        dense = []
        for phi, size in [(0.0, 3), (1.0, 5), (0.8, 6), (0.9, 6), (0.98, 6)]:
            p = np.full_like(alpha, phi)
            sse = smoothing._filter(y, np.array([50]), alpha, alpha * share * (phi > 0), p)[0]
            dense.append(smoothing._criterion(sse, 50, np.array(size)).min())
        assert smoothing.best_smoothing(y, np.array([50]))[0][0] <= min(dense) + 0.5


def test_gaps_are_carried_forward():
    y = np.array([np.nan, 2.0, np.nan, np.nan, 5.0])
    assert smoothing.without_gaps(y).tolist() == [0.0, 2.0, 2.0, 2.0, 5.0]


def test_features_do_not_depend_on_row_order_or_partitions(spark, sf):
    panel = queries.prepared(spark, sf).cache()
    one = decompose.mstl_features(panel, 12)
    other = decompose.mstl_features(panel.orderBy(F.rand(1)).repartition(3), 12)
    assert one.columns == [*panel.columns, "trend", "seasonal"]
    assert one.count() == panel.count()
    assert one.exceptAll(other).isEmpty()
    panel.unpersist()


def test_future_features_cover_the_future_calendar(spark, sf):
    panel = queries.prepared(spark, sf).cache()
    future = pipeline.future_frame(panel, 6, "MS", 12)
    keys = future.select("unique_id", "ds")
    calendar = future_calendar(panel, 6, "MS")
    assert keys.exceptAll(calendar).isEmpty() and calendar.exceptAll(keys).isEmpty()
    assert future.where("trend is null or seasonal is null").isEmpty()
    # The future season repeats the last cycle of the history.
    history = decompose.mstl_features(panel, 12).select(
        "unique_id", F.add_months("ds", 12).alias("ds"), F.col("seasonal").alias("before")
    )
    both = future.join(history, ["unique_id", "ds"])
    assert both.where("seasonal <> before").isEmpty() and not both.isEmpty()
    panel.unpersist()


def test_early_end_shortens_the_future(panel):
    df = panel({"a": [1, 2, 3, 4], "b": [1, 2, 3]})
    out = {(r.unique_id, str(r.ds)): r.trend for r in decompose.mstl_future(df, 12, 2, "MS").collect()}
    assert len(out) == 4
    assert out["b", "2024-05-01"] is not None and out["b", "2024-06-01"] is None
    assert [r.unique_id for r in decompose.misaligned_series(df).collect()] == ["b"]


def test_short_and_single_row_series(panel):
    df = panel({"a": [5], "b": [1, 2]})
    rows = decompose.mstl_features(df, 12).collect()
    assert all(r.seasonal == 0.0 for r in rows)
    assert next(r.trend for r in rows if r.unique_id == "a") == 5.0


def test_season_two_cycles_are_enough(panel):
    df = panel({"a": [1, 5] * 2})
    assert any(r.seasonal != 0 for r in decompose.mstl_features(df, 2).collect())


def test_series_function_sees_sorted_rows(spark, panel):
    def first_to_last(key, rows: pd.DataFrame) -> pd.DataFrame:
        assert rows["ds"].is_monotonic_increasing
        return pd.DataFrame({"unique_id": [key[0]], "change": [rows["y"].iloc[-1] - rows["y"].iloc[0]]})

    df = panel({"a": [1, 2, 9], "b": [4, 3]}).orderBy(F.desc("ds"))
    out = decompose.apply_per_series(df, first_to_last, "unique_id string, change double")
    assert {r.unique_id: r.change for r in out.collect()} == {"a": 8.0, "b": -1.0}


def test_horizon_must_be_positive(panel):
    with pytest.raises(ValueError):
        decompose.mstl_future(panel({"a": [1]}), 12, 0, "MS")
    with pytest.raises(ValueError):
        pipeline.future_frame(panel({"a": [1]}), 2, "MS", 12, ["price"])


def test_future_feature_function(panel):
    df = panel({"a": [1, 2, 3]})
    feature = pipeline.mstl_future_feature(df, 12, 2, "MS")
    out = pipeline.future_features(df, 2, "MS", [feature]).orderBy("ds").collect()
    assert [r.ds for r in out] == [datetime.date(2024, 4, 1), datetime.date(2024, 5, 1)]
    assert all(r.trend is not None for r in out)
