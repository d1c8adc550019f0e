from __future__ import annotations

import datetime
from dataclasses import replace

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from demandpanel.functions.columns import by_series
from demandpanel.functions.spec import LinearModel, ModelSpec, RollingMean, TreeModel
from demandpanel.operators import features, forecast
from demandpanel.operators.decompose import FEATURES
from demandpanel.plans import pipeline
from demandpanel.plans.policies import POLICIES, spec_for
from registry import queries

def few_trees(trees):
    """The policies with ``trees`` trees a model: the recursion does not depend on their number."""
    return {
        label: replace(spec, models={n: replace(m, trees=trees) for n, m in spec.models.items()})
        for label, spec in POLICIES.items()
    }


@pytest.fixture(scope="module")
def training(spark, sf):
    from demandpanel.sources import tables

    tables.write_training(queries.training(spark, sf), "model_training", FEATURES, buckets=2)
    return tables.read_training(spark, "model_training", FEATURES)


@pytest.fixture(scope="module")
def fitted(training):
    return pipeline.fit_all(training, policies=few_trees(3))


@pytest.fixture(scope="module")
def forecasts(training, fitted):
    out = pipeline.forecast_all(training, "MS", 12, 4, fitted=fitted)
    return out.persist()


def label_rows(training, label):
    return training.where(F.col("classification") == label).drop("classification")


def test_specs_survive_json():
    import json

    for spec in POLICIES.values():
        assert ModelSpec.from_dict(json.loads(json.dumps(spec.to_dict()))) == spec
    with pytest.raises(ValueError):
        spec_for("Seasonal")


@pytest.mark.parametrize(
    "transforms", [("local_scale", "difference"), ("difference", "difference"), ("log",)]
)
def test_unsupported_target_transforms_raise(transforms):
    with pytest.raises(ValueError):
        ModelSpec("bad", (1,), target_transforms=transforms)


def test_unknown_model_kind_raises(spark):
    with pytest.raises(ValueError):
        forecast.build_estimator(TreeModel("forest"))
    built = forecast.build_estimator(POLICIES["Intermittent"].models["xgb"])
    assert (built.getMaxIter(), built.getMaxDepth(), built.getSubsamplingRate()) == (300, 6, 0.8)


def test_one_forecast_per_series_and_period(training, forecasts):
    assert forecasts.columns == ["unique_id", "ds", "y_pred"]
    series = training.select("unique_id").distinct().count()
    assert forecasts.count() == 4 * series
    assert forecasts.where("y_pred is null or isnan(y_pred)").isEmpty()
    dates = [r.ds for r in forecasts.select("ds").distinct().orderBy("ds").collect()]
    last = training.agg(F.max("ds")).first()[0]
    assert len(dates) == 4 and dates[0] > last and all(d.day == 1 for d in dates)


@pytest.mark.parametrize("label", sorted(POLICIES))
def test_first_step_is_a_one_row_prediction(spark, training, fitted, forecasts, label):
    """The state of a series gives the same features as the training windows would."""
    model = fitted[label]
    rows = label_rows(training, label)
    future = pipeline.future_frame(
        rows, 1, "MS", 12, last=training.agg(F.max("ds").alias("hi"))
    )
    # A placeholder target is fine: no feature of the row looks at its own target,
    # except through the scaler, so z is rebuilt from the history alone.
    history = features.transform_target(rows, model.spec)
    scaler = rows
    if "local_scale" in model.spec.target_transforms:
        base = rows
        if "difference" in model.spec.target_transforms:
            base = features.difference(rows, "y", "y")
        scaler = base.groupBy("unique_id").agg(
            F.avg("y").alias("centre"), F.stddev_pop("y").alias("scale")
        )
    ids = rows.select("unique_id").distinct()
    added = future.join(ids, "unique_id").select("*", F.lit(None).cast("double").alias("y"))
    both = history.select("unique_id", "ds", F.col("z").alias("y"), *FEATURES).unionByName(
        added.select("unique_id", "ds", "y", *FEATURES)
    )
    plain = ModelSpec("plain", model.spec.lags, model.spec.lag_transforms, (), {})
    matrix = features.lag_features(both, plain, FEATURES, keep_incomplete=True)
    last = matrix.join(future.select("unique_id", "ds"), ["unique_id", "ds"])
    levels = rows.groupBy("unique_id").agg(F.max_by("y", "ds").alias("level"))
    last = last.join(levels, "unique_id")
    if "local_scale" in model.spec.target_transforms:
        last = last.join(scaler, "unique_id")
    total = F.lit(0.0)
    scored = last.withColumn(
        "features", forecast._feature_vector([f"`{c}`" for c in model.feature_names])
    )
    for name, m in model.models.items():
        scored = m.transform(scored).withColumnRenamed("prediction", f"p_{name}")
        value = F.col(f"p_{name}")
        for step in reversed(model.spec.target_transforms):
            if step == "local_scale":
                value = value * F.col("scale") + F.col("centre")
            else:
                value = value + F.col("level")
        total = total + value / len(model.models)
    expected = scored.select("unique_id", "ds", total.alias("expected"))
    joined = expected.join(forecasts, ["unique_id", "ds"]).collect()
    assert len(joined) == ids.count()
    for row in joined:
        assert row.y_pred == pytest.approx(row.expected, rel=1e-9)


def test_recursion_by_hand(spark, panel):
    """A spec whose model is known: each step must see the step before it."""
    values = {k: [float((i * 7 + j * 3) % 11) for i in range(30)] for j, k in enumerate("abc")}
    rows = panel(values)
    spec = ModelSpec(
        "hand", (1, 2), {1: (RollingMean(3),)}, ("difference",),
        {"gbt": TreeModel("gbt", trees=3, depth=3)},
    )
    fitted = forecast.fit_label(rows, "hand", spec)
    ids = rows.select("unique_id").distinct()
    dates = [datetime.date(2026, 7 + i, 1) for i in range(5)]
    future = ids.crossJoin(spark.createDataFrame([(d,) for d in dates], "ds date"))
    out = forecast.forecast_label(fitted, rows, future, 5).orderBy("unique_id", "ds").collect()
    model = fitted.models["gbt"]
    for key, series in values.items():
        level, z = series[-1], list(np.diff(series))
        expected = []
        for _ in range(5):
            from pyspark.ml.linalg import Vectors

            p = model.predict(Vectors.dense([z[-1], z[-2], np.mean(z[-3:])]))
            z.append(p)
            level += p
            expected.append(level)
        got = [r.y_pred for r in out if r.unique_id == key]
        assert got == pytest.approx(expected)


def test_own_future_frame_gives_the_same_forecast(training, fitted, forecasts):
    label = "Erratic"
    rows = label_rows(training, label)
    future = pipeline.future_frame(training, 4, "MS", 12)
    given = forecast.forecast_label(fitted[label], rows, future, 4)
    both = given.withColumnRenamed("y_pred", "given").join(forecasts, ["unique_id", "ds"])
    assert both.count() == given.count() > 0
    assert both.where(F.abs(F.col("given") - F.col("y_pred")) > 1e-6).isEmpty()
    with pytest.raises(PySparkException, match="Too few future rows"):
        forecast.forecast_label(fitted[label], rows, future, 5).collect()
    one = rows.agg(F.min("unique_id")).first()[0]
    lost = future.where(F.col("unique_id") != one)
    with pytest.raises(PySparkException, match="Too few future rows"):
        forecast.forecast_label(fitted[label], rows, lost, 1).collect()


def test_long_horizons_checkpoint(training, fitted):
    label = "Erratic"
    rows = label_rows(training, label)
    out = pipeline.forecast_all(
        rows.withColumn("classification", F.lit(label)), "MS", 12, 14, fitted={label: fitted[label]}
    )
    assert out.groupBy("unique_id").count().where("count <> 14").isEmpty()


def test_argument_checks(training, fitted):
    rows = label_rows(training, "Smooth")
    with pytest.raises(ValueError):
        pipeline.forecast_all(training, "MS", 12, 0, fitted=fitted)
    with pytest.raises(ValueError):
        forecast.forecast_label(None, rows, rows, 1)
    with pytest.raises(ValueError):
        forecast.backtest_label(rows, "Smooth", spec_for("Smooth"), 0, 3)
    with pytest.raises(ValueError):
        forecast.backtest_label(rows, "Smooth", spec_for("Smooth"), 1, 3, features="per_fold")


def test_no_rows_no_model(training):
    assert forecast.fit_label(training.limit(0), "Smooth", spec_for("Smooth")) is None
    empty = pipeline.forecast_all(training.limit(0), "MS", 12, 3)
    assert empty.columns == ["unique_id", "ds", "y_pred"] and empty.isEmpty()
    backtest = pipeline.backtest_all(training.limit(0), 1, 3)
    assert backtest.isEmpty()
    assert dict(backtest.dtypes)["cutoff"] == "date"


def test_importance_sums_to_one_per_model(training, fitted):
    out = pipeline.importance_all(training, fitted=fitted)
    assert out.columns == ["classification", "model", "feature_name", "importance"]
    sums = out.groupBy("classification", "model").agg(F.sum("importance").alias("s")).collect()
    assert len(sums) == 5
    assert all(r.s == pytest.approx(1.0) for r in sums)


def test_save_and_load(spark, training, fitted, tmp_path):
    for label in ("Smooth", "Lumpy"):
        path = str(tmp_path / label)
        forecast.save_fitted(spark, fitted[label], path)
        loaded = forecast.load_fitted(spark, path)
        assert loaded.spec == fitted[label].spec
        assert loaded.feature_names == fitted[label].feature_names
        before = pipeline.forecast_all(training, "MS", 12, 2, fitted={label: fitted[label]})
        after = pipeline.forecast_all(training, "MS", 12, 2, fitted={label: loaded})
        assert before.exceptAll(after).isEmpty()
    with pytest.raises(ValueError):
        forecast.save_fitted(spark, None, str(tmp_path / "none"))


@pytest.mark.parametrize("mode", ["as_given", "per_fold"])
def test_backtest_folds(training, mode):
    label = "Intermittent"
    rows = training.where(F.col("classification") == label)
    out = pipeline.backtest_all(
        rows, 2, 3, policies=few_trees(1), features=mode, season_length=12
    ).persist()
    assert out.columns == ["unique_id", "ds", "cutoff", "y", "y_pred", "classification"]
    assert out.where("ds <= cutoff").isEmpty()
    series = rows.select("unique_id").distinct().count()
    assert out.count() == series * 2 * 3
    assert out.groupBy("unique_id", "cutoff").count().where("count <> 3").isEmpty()
    # The held-out targets are the panel's own.
    actual = rows.select("unique_id", "ds", F.col("y").alias("actual"))
    assert out.join(actual, ["unique_id", "ds"]).where("y <> actual").isEmpty()
    folds = forecast.cv_folds(rows, 2, 3).where("part = 'test'")
    assert out.select("unique_id", "ds", "cutoff").exceptAll(
        folds.select("unique_id", "ds", "cutoff")
    ).isEmpty()
    out.unpersist()


def test_per_fold_features_do_not_see_the_future(spark, training):
    """Changing the held-out targets must not change what a fold is trained on."""
    from demandpanel.operators.decompose import series_rows

    rows = label_rows(training, "Erratic")
    columns = ["ds", "y", *FEATURES]
    last = F.max("ds").over(by_series())
    changed = rows.withColumn("y", F.when(F.col("ds") == last, F.col("y") + 1e6).otherwise(F.col("y")))

    def refitted(panel):
        folded = forecast._fold_series(series_rows(panel, columns[1:]), 1, 3, 0)
        out = forecast._refit_features(folded, 12, 3, columns)
        return out.select("unique_id", "history", F.transform("ahead", lambda r: r["trend"]).alias("t"))

    assert refitted(rows).exceptAll(refitted(changed)).isEmpty()


def test_static_columns(training):
    """String statics are hashed, others taken as numbers."""
    label = "Erratic"
    rows = label_rows(training, label).withColumns(
        {"segment": F.split("unique_id", "_")[1], "level": F.length("unique_id")}
    )
    spec = ModelSpec("s", (1, 2), {}, ("difference",), {"gbt": TreeModel("gbt", trees=2, depth=3)})
    last = rows.agg(F.max("ds").alias("hi"))
    fitted = forecast.fit_label(rows, label, spec, FEATURES, ["segment", "level"])
    assert fitted.text == ("segment",)
    assert fitted.feature_names == ["segment", "level", *FEATURES, "lag1", "lag2"]
    out = forecast.forecast_label_ahead(fitted, rows, 2, "MS", 12, last)
    assert out.count() == 2 * rows.select("unique_id").distinct().count()
    assert out.where("y_pred is null").isEmpty()


def test_linear_spec_survives_json():
    spec = ModelSpec("l", (1,), models={"linear": LinearModel(penalty=0.5)})
    assert ModelSpec.from_dict(spec.to_dict()) == spec


def test_checkpoints_are_asked_for(training):
    """A forecast cut into pieces equals the one in one piece."""
    spec = ModelSpec("l", (1,), {}, ("difference",), {"linear": LinearModel()})
    rows = label_rows(training, "Erratic")
    fitted = forecast.fit_label(rows, "Erratic", spec)
    last = rows.agg(F.max("ds").alias("hi"))
    whole, pieces = (
        forecast.forecast_label_ahead(fitted, rows, 5, "MS", 12, last, every) for every in (None, 2)
    )
    assert whole.exceptAll(pieces).isEmpty() and pieces.exceptAll(whole).isEmpty()


def test_ensemble_skips_missing_models(spark):
    from demandpanel.functions.columns import row_mean

    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, 4.0)], "a double, b double")
    out = [r[0] for r in df.select(row_mean([F.col("a"), F.col("b")])).collect()]
    assert out == [1.0, None, 3.0]
