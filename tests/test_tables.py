from __future__ import annotations

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from demandpanel.plans import pipeline
from demandpanel.sources import tables


def test_duplicate_keys_raise_by_default(panel):
    df = panel({"a": [("2024-01-01", 1), ("2024-01-01", 2)]})
    with pytest.raises(PySparkException, match="Duplicate key: a 2024-01-01"):
        tables.unique_keys(df).collect()
    assert tables.unique_keys(df, "sum").first().y == 3.0
    assert tables.unique_keys(df, "first").first().y == 1.0
    with pytest.raises(ValueError):
        tables.unique_keys(df, "last")


def test_first_prefers_a_known_target(panel):
    df = panel({"a": [("2024-01-01", None), ("2024-01-01", 7)]})
    assert tables.inbound(df).first().y == 7.0


def test_null_keys_raise_or_are_left_out(spark):
    rows = [("a", "2024-01-01", "1.5"), (None, "2024-01-01", "2"), ("b", "soon", "x")]
    raw = spark.createDataFrame(rows, "k string, t string, v string")
    with pytest.raises(PySparkException):
        tables.standardise(raw, "k", "t", "v").collect()
    out = tables.standardise(raw, "k", "t", "v", mode="permissive").collect()
    assert [(r.unique_id, r.ds, r.y) for r in out] == [("a", datetime.date(2024, 1, 1), 1.5)]


def test_nan_counts_as_null(spark):
    raw = spark.createDataFrame([(1, datetime.date(2024, 1, 1), float("nan"))], "k int, t date, v double")
    assert tables.standardise(raw, "k", "t", "v").first().y is None


def test_argument_checks(spark, panel):
    df = panel({"a": [1]})
    with pytest.raises(ValueError):
        tables.read_table(spark, " ")
    with pytest.raises(ValueError):
        tables.standardise(df, "unique_id", "ds", "missing")
    with pytest.raises(ValueError):
        tables.write_training(df, "t", None)
    with pytest.raises(ValueError):
        tables.write_training(df, "t", ["trend"])


def test_a_side_without_rows_raises_when_it_is_read(spark, panel, tmp_path):
    df = panel({"a": [1, 2, 3]})
    df.write.parquet(str(tmp_path / "p"))
    for frame in (df, spark.read.parquet(str(tmp_path / "p"))):
        train, test = tables.split_at(frame, "2024-02-01")
        assert (train.count(), test.count()) == (2, 1) and train.columns == frame.columns
        train, test = tables.split_at(frame, "2030-01-01")
        assert train.count() == 3
        with pytest.raises(PySparkException, match="No rows in: test"):
            test.count()
        with pytest.raises(PySparkException, match="No rows in: test"):
            tables.unique_keys(test, "sum").collect()
        with pytest.raises(PySparkException, match="No rows in: train"):
            tables.split_at(frame, "2000-01-01")[0].collect()
        assert tables.split_at(frame, "2030-01-01", check=False)[1].isEmpty()


def test_date_limits_reach_the_scan(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    before = tables.standardise(lines, "l_partkey", "l_shipdate", "l_quantity", until="1999-06-30")
    after = tables.standardise(lines, "l_partkey", "l_shipdate", "l_quantity", after="1999-06-30")
    for part, operator in ((before, "LessThan"), (after, "GreaterThanOrEqual")):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert f"{operator}(l_shipdate,1999-07-01" in plan
        assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_shipdate:" in plan
    assert before.count() + after.count() == lines.count()
    assert before.agg(F.max("ds")).first()[0] == datetime.date(1999, 6, 30)


def test_training_table_roundtrip_fills_missing_targets(spark, panel):
    df = panel({"a": [1, None], "b": [2]}).withColumns(
        {"classification": F.lit("Lumpy"), "trend": F.lit(1.0), "extra": F.lit(0)}
    )
    tables.write_training(df, "rt_plain", ["trend"])
    tables.write_training(df, "rt_laid_out", ["trend"], partition_by_label=True, buckets=2)
    for name in ("rt_plain", "rt_laid_out"):
        out = tables.read_training(spark, name, ["trend"])
        assert out.columns == ["unique_id", "ds", "y", "classification", "trend"]
        assert sorted(r.y for r in out.collect()) == [0.0, 1.0, 2.0]
    tables.write_training(df.where("unique_id = 'b'"), "rt_plain", ["trend"])
    assert spark.table("rt_plain").count() == 1


def test_forecast_table_appends_and_stamps(spark, panel):
    df = panel({"a": [1, 2]}).withColumnRenamed("y", "y_pred")
    tables.append_forecasts(df, "v1", "fc")
    tables.append_forecasts(df, "v2", "fc")
    out = spark.table("fc")
    assert dict(out.dtypes) == {
        "unique_id": "string", "ds": "date", "y_pred": "double",
        "process_date": "timestamp", "version": "string",
    }
    assert out.groupBy("version").count().count() == 2 and out.count() == 4


def test_a_version_is_replaced_and_others_stay(spark, panel):
    df = panel({"a": [1, 2], "b": [3, 4]}).withColumnRenamed("y", "y_pred")

    def stored():
        rows = spark.table("fc_replaced").collect()
        return sorted((r.version, r.unique_id, str(r.ds), r.y_pred) for r in rows)

    tables.replace_forecasts(df, "v1", "fc_replaced")
    first = stored()
    tables.replace_forecasts(df.where("unique_id = 'a'"), "it's 2", "fc_replaced")
    tables.replace_forecasts(df, "v1", "fc_replaced")
    assert len(first) == 4 and [r for r in stored() if r[0] == "v1"] == first
    assert [r[1] for r in stored() if r[0] == "it's 2"] == ["a", "a"]
    tables.append_forecasts(df, "v1", "fc_replaced")
    assert len(stored()) == 10
    tables.replace_forecasts(df.limit(0), "v1", "fc_replaced")
    assert {r[0] for r in stored()} == {"it's 2"}
    df.withColumn("version", F.lit("x")).write.saveAsTable("fc_plain")
    with pytest.raises(ValueError, match="not partitioned by version"):
        tables.replace_forecasts(df, "x", "fc_plain")


def test_layout_sorts_inside_ranges(spark, sf):
    from registry import panels

    out = pipeline.layout_by_series(panels.supplier_month(spark, sf), partitions=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(unique_id" in plan
    keyed = out.withColumn("p", F.spark_partition_id())
    assert keyed.groupBy("unique_id").agg(F.countDistinct("p").alias("n")).where("n > 1").isEmpty()
    with pytest.raises(ValueError):
        pipeline.layout_by_series(out, " ")
    with pytest.raises(ValueError):
        pipeline.layout_by_series(out, "nope")
