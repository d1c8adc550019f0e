from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from demandpanel.operators import impute


def ys(df):
    return [r.y for r in df.orderBy("ds").collect()]


def test_gap_longer_than_window_is_forward_filled(panel):
    df = panel({"a": [4, None, None, None, None]})
    assert ys(impute.impute_rolling_mean(df, 3)) == [4.0] * 5


def test_rolling_mean_sees_original_values_only(panel):
    df = panel({"a": [2, 6, None, None]})
    assert ys(impute.impute_rolling_mean(df, 3)) == [2.0, 6.0, 4.0, 6.0]


def test_median_is_the_lower_middle_value(panel):
    assert ys(impute.impute_rolling_median(panel({"a": [20, 40, None]}), 4)) == [20.0, 40.0, 20.0]


def test_fallback_before_the_first_value(panel):
    df = panel({"a": [None, 5]})
    assert ys(impute.impute_rolling_median(df, 4, fallback=1.5)) == [1.5, 5.0]
    assert ys(impute.impute_zero(df)) == [0.0, 5.0]


def test_window_must_be_positive(panel):
    for operator in (impute.impute_rolling_mean, impute.impute_rolling_median):
        with pytest.raises(ValueError):
            operator(panel({"a": [1]}), 0)


def test_policy_must_cover_all_labels(panel):
    df = panel({"a": [1]}).withColumn("classification", F.lit("Smooth"))
    with pytest.raises(ValueError):
        impute.impute_by_class(df, {"Smooth": impute.zero})
    with pytest.raises(ValueError):
        impute.impute_by_class(df.drop("classification"))


def test_unknown_labels_are_left_out(panel):
    df = panel({"a": [1], "b": [2], "c": [3]})
    label = F.when(F.col("unique_id") == "a", "Smooth").when(F.col("unique_id") == "b", "Other")
    out = impute.impute_by_class(df.withColumn("classification", label))
    assert [r.unique_id for r in out.collect()] == ["a"]


def test_each_label_has_its_own_rule(panel):
    values = [10, 30, 80, None]
    df = panel({k: values for k in ("Smooth", "Erratic", "Lumpy", "Intermittent")})
    out = impute.impute_by_class(df.withColumn("classification", F.col("unique_id")))
    last = {r.unique_id: r.y for r in out.where("ds = date'2024-04-01'").collect()}
    assert last == {"Smooth": 55.0, "Erratic": 30.0, "Lumpy": 30.0, "Intermittent": 0.0}
