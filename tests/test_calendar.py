from __future__ import annotations

import datetime
import warnings

import pandas as pd
import pytest

from demandpanel.functions.frequency import parse_frequency
from demandpanel.operators.calendar import (
    calendar, fill_calendar, future_calendar, off_calendar_rows,
)

ALIASES = [
    "D", "2D", "B", "3B", "W", "2W-MON", "W-WED", "MS", "2MS", "ME", "3ME", "QS", "QE",
    "QS-FEB", "2QE-JAN", "YS", "YE", "YE-MAR", "2YS-APR", "BMS", "2BMS", "BME", "3BME", "BQS",
    "BQE-JAN", "BYS-MAR", "BYE", "SMS", "SME", "3SMS", "SMS-20", "2SME-7",
]
RANGES = [("1969-11-15", "1972-03-01"), ("2024-02-29", "2026-12-31"), ("2023-01-01", "2023-12-31")]


@pytest.mark.parametrize("alias", ALIASES)
def test_calendar_equals_pandas_date_range(spark, alias):
    for lo, hi in RANGES:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            expected = [d.date() for d in pd.date_range(lo, hi, freq=alias)]
        assert [r.ds for r in calendar(spark, alias, lo, hi).orderBy("ds").collect()] == expected


@pytest.mark.parametrize("alias", ["D", "2D", "B", "W", "2W-MON", "MS", "ME", "3MS", "QE", "YS", "BMS", "BME", "SMS", "SME"])
@pytest.mark.parametrize("last", ["2024-01-31", "2024-01-15"])
def test_future_calendar_is_the_anchors_after_the_last_date(spark, panel, alias, last):
    future = future_calendar(panel({"a": [(last, 1)]}), 4, alias)
    got = [r.ds for r in future.orderBy("ds").collect()]
    dates = pd.date_range(last, periods=6, freq=alias)
    assert got == [d.date() for d in dates if d > pd.Timestamp(last)][:4]


@pytest.mark.parametrize("bad", ["h", "min", "H", "", "0D", "D-MON", "W-JAN", "BMS-JAN", "SMS-JAN", "SMS-1", "SME-28", "0SMS", None])
def test_unknown_frequencies_raise(bad):
    with pytest.raises(ValueError):
        parse_frequency(bad)


def test_deprecated_aliases():
    assert parse_frequency("M") == parse_frequency("ME")
    assert parse_frequency("Q") == parse_frequency("QE-DEC")
    assert parse_frequency("A") == parse_frequency("YE")


def rows(df):
    return [(r.unique_id, str(r.ds), r.y) for r in df.orderBy("unique_id", "ds").collect()]


def test_bounds_are_global_and_gaps_are_null(panel):
    df = panel({"a": [("2024-01-01", 1), ("2024-03-01", 3)], "b": [("2024-02-01", 2)]})
    assert rows(fill_calendar(df, "MS")) == [
        ("a", "2024-01-01", 1.0), ("a", "2024-02-01", None), ("a", "2024-03-01", 3.0),
        ("b", "2024-01-01", None), ("b", "2024-02-01", 2.0), ("b", "2024-03-01", None),
    ]


def test_off_anchor_rows_are_lost_but_hold_the_series(panel):
    df = panel({"a": [("2024-01-15", 1), ("2024-02-29", 2)], "b": [("2024-02-10", 5)]})
    assert rows(fill_calendar(df, "ME")) == [
        ("a", "2024-01-31", None), ("a", "2024-02-29", 2.0),
        ("b", "2024-01-31", None), ("b", "2024-02-29", None),
    ]
    assert rows(off_calendar_rows(df, "ME")) == [("a", "2024-01-15", 1.0), ("b", "2024-02-10", 5.0)]


def test_repeated_keys_stay(panel):
    df = panel({"a": [("2024-01-01", 1), ("2024-01-01", 1), ("2024-03-01", 3)]})
    assert [r[2] for r in rows(fill_calendar(df, "MS"))] == [1.0, 1.0, None, 3.0]


def test_varying_static_gives_one_panel(spark):
    d = datetime.date
    df = spark.createDataFrame(
        [("a", d(2024, 1, 1), 1.0, "x"), ("a", d(2024, 3, 1), 2.0, "z")],
        "unique_id string, ds date, y double, kind string",
    )
    out = fill_calendar(df, "MS", ["kind"]).orderBy("ds").collect()
    assert [(r.kind, r.y) for r in out] == [("z", 1.0), ("z", None), ("z", 2.0)]


def test_given_bounds_extend_the_calendar(panel):
    df = panel({"a": [("2024-02-01", 2)]})
    out = rows(fill_calendar(df, "MS", bounds=("2024-01-01", "2024-03-31")))
    assert [r[2] for r in out] == [None, 2.0, None]


def test_narrow_bounds_cut_the_panel(panel):
    df = panel({"a": [1, 2, 3, 4, 5], "b": [7], "c": [("2024-05-01", 9)]})
    out = rows(fill_calendar(df, "MS", bounds=("2024-02-01", "2024-03-31")))
    assert [(r[0], r[2]) for r in out] == [
        ("a", 2.0), ("a", 3.0), ("b", None), ("b", None), ("c", None), ("c", None),
    ]
    lost = rows(off_calendar_rows(df, "MS", bounds=("2024-02-01", "2024-03-31")))
    assert [r[2] for r in lost] == [1.0, 4.0, 5.0, 7.0, 9.0]


def test_bounds_without_any_period(panel):
    df = panel({"a": [("2024-01-10", 1), ("2024-01-20", 2)]})
    assert rows(fill_calendar(df, "MS")) == []


def test_column_order_keeps_target_last(spark, panel):
    from pyspark.sql import functions as F

    df = panel({"a": [1]}).withColumn("kind", F.lit("x")).withColumn("more", F.lit(1))
    assert fill_calendar(df, "MS", ["kind"]).columns == ["unique_id", "ds", "kind", "y", "more"]
