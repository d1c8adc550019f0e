from __future__ import annotations

from functools import partial

import pytest
from pyspark.sql import functions as F

from demandpanel.operators import clean
from demandpanel.operators.calendar import fill_calendar
from demandpanel.operators.classify import classify_demand, demand_metrics
from demandpanel.operators.prepare import labelled_panel
from registry import panels

SERIES = {
    "all_null": [None, None],
    "all_zero": [0, 0, 0],
    "negative": [-1, 0],
    "null_tail": [2, 0, None],
    "zero_tail": [0, 5, 0, 0],
    "null_then_zeros": [1, None, 0, 0],
    "single": [3],
    "late": [None, 0, None, 4, 0, 1],
}


def values(df) -> dict:
    out = {}
    for r in df.orderBy("unique_id", "ds").collect():
        out.setdefault(r.unique_id, []).append(r.y)
    return out


def test_leading_nulls(panel):
    out = values(clean.trim_leading_nulls(panel(SERIES)))
    assert out["all_null"] == [None, None]
    assert out["late"] == [0, None, 4, 0, 1]


def test_leading_zeros_take_nulls_with_them(panel):
    out = values(clean.trim_leading_zeros(panel(SERIES)))
    assert out["all_zero"] == [0, 0, 0]
    assert out["all_null"] == [None, None]
    assert out["late"] == [4, 0, 1]
    assert out["zero_tail"] == [5, 0, 0]


def test_zero_only(panel):
    kept = set(values(clean.drop_zero_only(panel(SERIES))))
    assert kept == set(SERIES) - {"all_zero", "negative"}


@pytest.mark.parametrize(
    "n, dropped",
    [
        (0, set()),
        (2, {"all_zero", "zero_tail", "null_then_zeros"}),
        (3, {"all_zero"}),
        (1, {"all_zero", "negative", "zero_tail", "null_then_zeros"}),
    ],
)
def test_inactive(panel, n, dropped):
    kept = set(values(clean.drop_inactive(panel(SERIES), n)))
    assert kept == set(SERIES) - dropped


def test_nulls_may_count_as_inactive(panel):
    kept = set(values(clean.drop_inactive(panel(SERIES), 2, nulls_inactive=True)))
    assert kept == {"negative", "single", "late"}


def test_short_counts_nulls(panel):
    assert set(values(clean.drop_short(panel(SERIES), 3))) == {
        "all_zero", "null_tail", "zero_tail", "null_then_zeros", "late",
    }
    assert set(values(clean.drop_short(panel(SERIES), 0))) == set(SERIES)


def test_clean_checks_its_steps(panel):
    df = panel(SERIES)
    with pytest.warns(UserWarning):
        assert clean.clean(df, []) is df
    with pytest.raises(TypeError):
        clean.clean(df, ["drop_short"])
    out = clean.clean(df, [clean.trim_leading_nulls, partial(clean.drop_short, min_records=5)])
    assert set(values(out)) == {"late"}


@pytest.mark.parametrize(
    "name, unfilled, filled",
    [
        ("part_returns_nullable", 41182, 137190),
        ("customer_refunds", 5916, 84259),
        ("nation_segment", 7501, 9958),
    ],
)
def test_known_row_counts(spark, sf, name, unfilled, filled):
    df = getattr(panels, name)(spark, sf)
    assert clean.clean_series(df, 3, 8).count() == unfilled
    assert clean.clean_series(fill_calendar(df, "MS"), 3, 8).count() == filled


@pytest.mark.parametrize(
    "name, freq, inactivity, min_records",
    [
        ("part_returns_nullable", "MS", 3, 8),
        ("part_returns_nullable", "MS", 1, 0),
        ("customer_refunds", "2MS", 2, 20),
        ("customer_refunds", "2MS", 1, 0),
        ("customer_refunds", "QE", 1, 2),
        ("order_day", "MS", 2, 20),
        ("order_day", "W", 1, 0),
        ("user_day", "D", 0, 0),
    ],
)
def test_fused_panel_equals_the_steps(spark, sf, name, freq, inactivity, min_records):
    df = getattr(panels, name)(spark, sf)
    steps = clean.standard_steps(freq, inactivity, min_records)

    def rounded(out):
        return out.withColumn("y", F.round("y", 6)).cache()

    stepwise = rounded(classify_demand(clean.clean(df, steps)))
    fused = rounded(labelled_panel(df, freq, inactivity, min_records))
    assert fused.columns == stepwise.columns
    assert fused.count() == stepwise.count() > 0
    assert stepwise.exceptAll(fused).count() == 0


def test_fused_panel_on_hand_made_series(panel):
    df = panel(SERIES)
    for inactivity, min_records in [(0, 0), (1, 0), (2, 0), (3, 4)]:
        steps = clean.standard_steps("MS", inactivity, min_records)
        stepwise = classify_demand(clean.clean(df, steps))
        fused = labelled_panel(df, "MS", inactivity, min_records)
        assert values(fused) == values(stepwise)
        assert stepwise.exceptAll(fused).count() == 0


def test_labels_of_hand_made_series(panel):
    out = {r.unique_id: r for r in demand_metrics(panel(SERIES)).collect()}
    assert (out["single"].adi, out["single"].cv2) == (1.0, 0.0)
    assert out["single"].classification == "Smooth"
    assert out["all_null"].adi == float("inf") and out["all_null"].cv2 == float("inf")
    assert out["all_null"].classification == "Lumpy"
    assert out["negative"].classification == "Lumpy"
    assert out["null_tail"].adi == 3.0


def test_report(panel):
    df = panel(SERIES)
    row = clean.cleaning_report(df, clean.drop_zero_only(df)).first()
    assert (row.series_before, row.series_dropped, row.rows_dropped) == (8, 2, 5)


def test_prepare_keeps_static_columns(spark, sf):
    from demandpanel.operators.prepare import prepare

    df = panels.part_month_static(spark, sf)
    out = prepare(df, "MS", 3, 8, ["p_brand", "p_size"])
    assert out.columns == ["unique_id", "ds", "p_brand", "p_size", "y", "classification"]
    plain = prepare(df.select("unique_id", "ds", "y"), "MS", 3, 8)
    assert out.drop("p_brand", "p_size").exceptAll(plain).isEmpty()
    assert out.where("y is null or p_brand is null or p_size is null").isEmpty()
