"""The plans themselves: no jobs while building, shuffles where expected and nowhere else."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from demandpanel.functions.spec import ExponentialMean, ModelSpec, TreeModel
from demandpanel.operators import calendar, classify, clean, decompose, features, forecast
from demandpanel.operators.calendar import fill_calendar
from demandpanel.operators.impute import impute_by_class
from demandpanel.operators.prepare import prepare
from demandpanel.plans import pipeline
from demandpanel.plans.policies import POLICIES, spec_for
from demandpanel.sources import tables
from registry import panels, queries


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(df) -> int:
    return plan(df).count("Exchange hashpartitioning")


def jobs(spark) -> int:
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


@pytest.fixture(scope="module")
def stored(spark, sf):
    panels.nation_segment(spark, sf).write.mode("overwrite").saveAsTable("stored_panel")
    return spark.table("stored_panel")


def test_building_plans_runs_no_job(spark, stored):
    before = jobs(spark)
    prepared = prepare(stored, "MS", 3, 8)
    trained = pipeline.training_frame(prepared, 12)
    pipeline.future_frame(prepared, 6, "MS", 12)
    features.lag_features(trained, spec_for("Lumpy"), decompose.FEATURES)
    clean.cleaning_report(stored, clean.clean(stored, clean.standard_steps("MS", 3, 8)))
    classify.class_dispersion(classify.demand_metrics(stored))
    tables.dataset_bounds(a=stored, b=prepared)
    forecast.cv_folds(prepared, 2, 3)
    tables.split_at(stored, "1999-06-30")
    for frame in pipeline.train_test_future(
        spark, "stored_panel", "unique_id", "ds", "y", "1999-06-30", 6, "MS", 12, 3, 8
    ):
        plan(frame)
    assert jobs(spark) == before


def test_preparation_needs_one_shuffle(stored):
    assert hash_exchanges(fill_calendar(stored, "MS")) == 1
    assert hash_exchanges(prepare(stored, "MS", 3, 8)) == 1
    steps = clean.clean(stored, clean.standard_steps("MS", 3, 8))
    assert hash_exchanges(impute_by_class(classify.classify_demand(steps))) == 1
    assert "CartesianProduct" not in plan(prepare(stored, "MS", 3, 8))
    assert "NestedLoopJoin" not in plan(prepare(stored, "MS", 3, 8))


def test_decomposition_adds_no_shuffle_and_no_join(stored):
    trained = pipeline.training_frame(prepare(stored, "MS", 3, 8), 12)
    assert hash_exchanges(trained) == 1
    assert "Join" not in plan(trained)


def test_decomposition_runs_once_per_series(stored):
    prepared = prepare(stored, "MS", 3, 8)
    for out in (pipeline.training_frame(prepared, 12), pipeline.future_frame(prepared, 6, "MS", 12)):
        assert plan(out).count("ArrowEvalPython") == 1
    columns = ["ds", "y", *decompose.FEATURES]
    rows = decompose.series_rows(pipeline.training_frame(prepared, 12), columns[1:])
    folded = forecast._refit_features(forecast._fold_series(rows, 2, 3, 0), 12, 3, columns)
    train = folded.select("unique_id", decompose.explode_rows(F.col("history")).alias("r"))
    # Once for the panel's own features, once for the fold's.
    assert plan(train.select("unique_id", "r.*")).count("ArrowEvalPython") == 2


@pytest.mark.parametrize("label", sorted(POLICIES))
def test_lag_features_need_one_shuffle(stored, label):
    assert hash_exchanges(features.lag_features(stored, spec_for(label))) == 1


def test_bucketed_training_table_needs_no_shuffle(spark, sf):
    tables.write_training(
        queries.training(spark, sf), "bucketed", decompose.FEATURES,
        partition_by_label=True, buckets=4,
    )
    rows = tables.read_training(spark, "bucketed", decompose.FEATURES)
    smooth = rows.where(F.col("classification") == "Smooth").drop("classification")
    matrix = features.lag_features(smooth, spec_for("Smooth"), decompose.FEATURES)
    assert "Exchange" not in plan(matrix)
    assert "PartitionFilters: [isnotnull(classification" in plan(matrix)
    few = {"gbt": TreeModel("gbt", trees=2)}
    spec = replace(spec_for("Smooth"), models=few)
    fitted = forecast.fit_label(smooth, "Smooth", spec, decompose.FEATURES)
    last = rows.agg(F.max("ds").alias("hi"))
    for horizon in (1, 4):
        out = forecast.forecast_label_ahead(fitted, smooth, horizon, "MS", 12, last)
        assert hash_exchanges(out) == 0
        assert "Join" not in plan(out)


def test_futures_plan_the_panel_once(spark, stored):
    """The future after the training rows reads them once, and their bounds, but does not prepare twice."""
    _, _, future = pipeline.train_test_future(
        spark, "stored_panel", "unique_id", "ds", "y", "1999-06-30", 6, "MS", 12, 3, 8, check=False
    )
    text = plan(future)
    assert text.count("ArrowEvalPython") == 1
    assert text.split("Subqueries")[0].count("FileScan") - text.count("ReusedSubquery") <= 3


def test_bucketed_futures_are_joined_without_a_shuffle(spark, sf):
    from demandpanel.functions.spec import LinearModel
    from demandpanel.operators.harmonics import harmonic_features, harmonic_names

    year, names = harmonic_features("MS", {12: 2}), harmonic_names({12: 2})
    panels.nation_segment(spark, sf).write.mode("overwrite").saveAsTable("raw_panel")
    training = pipeline.build_training_table(
        spark, "raw_panel", "known_training", "unique_id", "ds", "y", "MS", 12, 3, 8, names,
        buckets=4, features=[year],
    )
    future = pipeline.build_future_table(
        spark, "known_training", "known_future", "MS", 12, 6, names, features=[year], buckets=4
    )
    assert future.columns == ["unique_id", "ds", *names] and "ArrowEvalPython" not in plan(future)
    spec = {k: replace(s, models={"l": LinearModel()}) for k, s in POLICIES.items()}
    fitted = pipeline.fit_all(training, names, policies=spec)
    out = pipeline.forecast_all(training, "MS", 12, 6, names, fitted=fitted, future=future)
    assert "Join" in plan(out) and hash_exchanges(out) == 0
    assert out.count() == 6 * training.select("unique_id").distinct().count()


def test_harmonics_go_on_into_the_future(spark, panel):
    import math

    from demandpanel.operators.harmonics import harmonic_features, harmonic_names

    df = panel({"a": [1] * 30})
    out = harmonic_features("MS", {12: 6, 5: 2})(df).orderBy("ds").collect()
    names = harmonic_names({12: 6, 5: 2})
    assert len(names) == 11 + 4 and "sin_12_6" not in names
    for k, row in enumerate(out):
        index = row.ds.year * 12 + row.ds.month - 1
        for name in names:
            wave, length, order = name.split("_")
            want = getattr(math, wave)(2 * math.pi * int(order) * index / int(length))
            assert math.isclose(row[name], want, abs_tol=1e-9)
        assert k < 12 or math.isclose(row["sin_12_1"], out[k - 12]["sin_12_1"])
    for bad in ({1: 1}, {12: 0}, {12: 7}):
        with pytest.raises(ValueError):
            harmonic_features("MS", bad)


def test_a_label_rule_of_ones_own(panel):
    df = panel({"a": [1, 2, 3, 4], "b": [1, None, None, 4]})
    out = prepare(df, "MS", 0, 0, classify=lambda adi, cv2: F.when(adi > 1.5, "Lumpy").otherwise("Smooth"))
    assert {r.unique_id: r.classification for r in out.collect()} == {"a": "Smooth", "b": "Lumpy"}


def test_cleaning_is_counted_while_it_is_written(spark, sf):
    from demandpanel.operators.prepare import CleaningObservation

    raw = panels.part_returns_nullable(spark, sf).persist()
    report = CleaningObservation()
    prepare(raw, "MS", 3, 8, report=report).write.format("noop").mode("overwrite").save()
    filled = fill_calendar(raw, "MS")
    want = clean.cleaning_report(filled, clean.clean_series(filled, 3, 8)).first().asDict()
    assert report.frame(spark).first().asDict() == want and want["series_dropped"] > 0
    assert not any(x in plan(report.frame(spark)) for x in ("FileScan", "InMemory", "Exchange"))
    raw.unpersist()


def test_keys_are_merged_before_the_shuffle(spark, sf):
    """Raw rows are grouped by the whole key with partial sums, whatever one series holds."""
    out = tables.read_series(
        spark, f"{sf}/lineitem.parquet", "l_partkey", "l_shipdate", "l_quantity", on_duplicate="sum"
    )
    exchange = next(line for line in plan(out).splitlines() if "hashpartitioning" in line)
    assert exchange.count("#") >= 2, "grouped by id and date, not by id alone"
    assert plan(out).index("hashpartitioning") < plan(out).index("partial_sum")
    assert hash_exchanges(out) == 1


def test_a_series_with_most_raw_rows(spark):
    """One id with nine tenths of the rows comes out right."""
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise((F.col("id") % 97).cast("string")).alias("k"),
        F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("id") / 10) % 50).cast("int")).alias("t"),
        F.lit(1.0).alias("v"),
    )
    panel = tables.unique_keys(tables.standardise(rows, "k", "t", "v"), "sum")
    out = prepare(panel, "D", 3, 8).where("unique_id = 'hot'")
    assert out.count() == 50 and out.agg(F.sum("y")).first()[0] == 90_000


def test_ewm_restarts_in_blocks(spark, panel):
    """Series longer than a block, with gaps, against the recursion itself."""
    import numpy as np

    rng = np.random.default_rng(0)
    for alpha in (0.3, 0.9):
        values = [float(v) if rng.random() > 0.1 else None for v in rng.normal(size=400)]
        spec = ModelSpec("ewm", (1,), {1: (ExponentialMean(alpha),)})
        out = features.lag_features(panel({"a": values}), spec, keep_incomplete=True)
        name = next(c for c in out.columns if c.startswith("ewm"))
        got = [r[name] for r in out.orderBy("ds").collect()]
        mean, expected = None, []
        for v in values:
            expected.append(mean)
            if v is not None:
                mean = v if mean is None else alpha * v + (1 - alpha) * mean
        for g, e in zip(got, expected):
            assert (g is None) == (e is None)
            assert g is None or abs(g - e) < 1e-9


def test_checkpoint_folder_comes_from_the_session(spark):
    from demandpanel.sources.checkpoints import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir")
    assert named in spark.sparkContext.getCheckpointDir()


def test_partitions_follow_the_size_of_the_filled_panel(spark, sf, monkeypatch):
    """No task holds more of a panel as it grows, whatever the session shuffles to."""
    small = queries.prepared(spark, sf, panels.part_month)
    monkeypatch.setattr(calendar, "TASK_ROWS", 8_000)
    size, bounds = calendar.panel_size(panels.part_month(spark, sf), "MS")
    assert 15 <= size <= 27  # 2,000 series of 83 months
    large = queries.prepared(spark, sf, panels.part_month)
    held = large.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert held < 2 * 8_000
    assert large.exceptAll(small).isEmpty() and small.exceptAll(large).isEmpty()
    source = queries._store_prepared(spark, sf, panels.part_month)
    stored = spark.table(source)
    buckets = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {source}").collect()}
    assert int(buckets["Num Buckets"]) == size and stored.count() == small.count()
    for name in ("trim_leading_nulls", "clean_steps"):
        assert "REPARTITION_BY_NUM" in plan(queries.QUERIES[name](spark, sf))
    assert calendar.panel_size(panels.part_month(spark, sf).where("false"), "MS") == (1, None)


def test_the_writer_keeps_the_layout_of_a_prepared_panel(spark, sf):
    rows = panels.part_month(spark, sf)
    prepared = prepare(rows, "MS", 3, 8, partitions=9).repartition(9, "unique_id")
    assert plan(prepared).count(", 9), REPARTITION_BY_NUM") == 1


def test_decomposed_batches_are_bounded(spark, monkeypatch):
    series = [np.zeros(n) for n in (3, 4, 50, 1, 2, 9, 1)]
    monkeypatch.setattr(decompose.smoothing, "PERIODS_AT_ONCE", 10)
    parts = list(decompose.smoothing.in_parts(series))
    assert [len(v) for part in parts for v in part] == [len(v) for v in series]
    assert all(sum(map(len, part)) - max(map(len, part)) <= 10 for part in parts)
    assert len(parts) > 3 and [len(p) for p in decompose.smoothing.in_parts([np.zeros(0)])] == [1]
    # What is handed back is cut too, so no more of a batch is held than a part and what is made of it.
    run = decompose._components_udf(2, 3).func
    batch = pd.Series([np.arange(6.0) + k for k in range(8)])
    out = list(run(iter([batch])))
    assert max(len(o) for o in out) <= 2
    monkeypatch.setattr(decompose.smoothing, "PERIODS_AT_ONCE", 1 << 19)
    whole = pd.concat(run(iter([batch])))
    for name in ("trend", "seasonal"):
        got = np.stack([v for o in out for v in o[name]])
        np.testing.assert_allclose(got, np.stack(list(whole[name])), atol=1e-9)


def test_raw_rows_are_merged_in_partitions_by_the_size_of_the_panel(spark, sf, monkeypatch):
    """The sums by series and date follow the panel's size too, not only what comes after them."""
    small = queries.prepared(spark, sf, panels.part_month).collect()
    monkeypatch.setattr(calendar, "TASK_ROWS", 8_000)
    shown = plan(large := queries.prepared(spark, sf, panels.part_month))
    session = spark.conf.get("spark.sql.shuffle.partitions")
    assert f", {session}), ENSURE_REQUIREMENTS" not in shown and shown.count("REPARTITION_BY_NUM") == 2
    assert sorted(large.collect()) == sorted(small)


def test_merged_keys_do_not_depend_on_the_partitions(spark):
    rows = [(f"s{i % 5}" if i % 11 else None, f"2024-01-0{1 + i % 3}", None if i % 4 == 0 else float(i)) for i in range(300)]
    rows += [("one", "2024-01-01", 1.0)] * 500  # a key of most rows
    df = spark.createDataFrame(rows, "unique_id string, ds string, y double").withColumn("ds", F.to_date("ds"))
    df = df.withColumn("static", F.length("unique_id")).repartition(6)
    for kind in ("sum", "first"):
        few, many = (tables.unique_keys(df, kind, n) for n in (None, 40))
        assert few.count() == many.count() == 19
        assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
    with pytest.raises(PySparkException, match="Duplicate key"):
        tables.unique_keys(df.where("unique_id = 'one'"), "error", 40).collect()
    singles = df.dropDuplicates(["unique_id", "ds"])
    assert tables.unique_keys(singles, "error", 40).count() == 19
