"""Models as expressions, least squares by aggregates, fits side by side."""

from __future__ import annotations

import threading
import time

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, IsotonicRegression, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import functions as F

from demandpanel.functions.scoring import least_squares, scorer
from demandpanel.functions.spec import (
    ExpandingStd, ExponentialMean, LinearModel, ModelSpec, RollingMean, TreeModel,
)
from demandpanel.operators import forecast


@pytest.fixture(scope="module")
def points(spark):
    r = np.random.default_rng(3)
    x = r.normal(0, 1, (400, 3)).round(3)
    z = x @ [1.0, -2.0, 0.5] + np.sin(3 * x[:, 0]) + r.normal(0, 0.1, 400)
    rows = [(i, *map(float, x[i]), 7.0, float(z[i]), i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double, k double, z double, fold int")
    return df.persist()


def vectors(points, *names):
    return points.withColumn("features", array_to_vector(F.array(*names))).withColumn("label", F.col("z"))


@pytest.mark.parametrize(
    "estimator",
    [
        lambda: GBTRegressor(maxIter=7, maxDepth=4, stepSize=0.3, subsamplingRate=0.8, seed=1),
        lambda: GBTRegressor(maxIter=2, maxDepth=1),
        lambda: DecisionTreeRegressor(maxDepth=5),
        lambda: DecisionTreeRegressor(maxDepth=0),
        lambda: RandomForestRegressor(numTrees=5, maxDepth=4, seed=2),
        lambda: LinearRegression(regParam=0.1),
    ],
    ids=["boosted", "stumps", "tree", "leaf", "forest", "linear"],
)
def test_expressions_equal_the_models(points, estimator):
    model = estimator().fit(vectors(points, "a", "b", "c"))
    how = scorer("m", model)
    nan = F.when(F.col("i") % 10 == 0, float("nan")).otherwise(F.col("b"))
    data = vectors(points.withColumn("b", nan), "a", "b", "c")
    both = model.transform(data).withColumns(how.columns).withColumn("x", F.array("a", "b", "c"))
    rows = both.select("prediction", F.expr(how.sql("x")).alias("own")).collect()
    same = [r for r in rows if not np.isnan(r["prediction"])]
    assert len(same) >= 360
    assert np.allclose([r["own"] for r in same], [r["prediction"] for r in same], rtol=1e-12)


def test_other_models_have_no_expression(points):
    assert scorer("m", IsotonicRegression().fit(vectors(points, "a"))) is None


@pytest.mark.parametrize("penalty", [0.0, 0.3, 5.0])
def test_least_squares_equal_spark(points, penalty):
    names = ["a", "b", "c", "k"]  # k is constant
    fit = least_squares(points, names, "z", {"m": penalty})["m"]
    model = LinearRegression(regParam=penalty, solver="normal").fit(vectors(points, *names))
    assert np.allclose(fit.coefficients, model.coefficients.toArray(), atol=1e-9)
    assert fit.intercept == pytest.approx(model.intercept)


def test_all_folds_are_solved_in_one_job(spark, points):
    before = jobs(spark)
    fits = least_squares(points, ["a", "b"], "z", {"m": 0.0}, by="fold")
    assert jobs(spark) - before <= 2  # a job a shuffle stage, under adaptive execution
    assert sorted(fits) == [0, 1, 2]
    for fold, models in fits.items():
        alone = least_squares(points.where(F.col("fold") == fold), ["a", "b"], "z", {"m": 0.0})
        assert np.allclose(models["m"].coefficients, alone["m"].coefficients)
    assert least_squares(points.limit(0), ["a"], "z", {"m": 0.0}) == {}
    assert least_squares(points.limit(0), ["a"], "z", {"m": 0.0}, by="fold") == {}


def jobs(spark) -> int:
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


SPEC = ModelSpec(
    "mixed", (1, 2), {1: (RollingMean(3), ExpandingStd()), 2: (ExponentialMean(0.4),)},
    ("difference", "local_scale"), {"linear": LinearModel(), "gbt": TreeModel("gbt", trees=2, depth=3)},
)


@pytest.fixture(scope="module")
def rows(panel):
    r = np.random.default_rng(6)
    return panel({f"s{k}": r.normal(10, 3, 40).round(2).tolist() for k in range(6)}).persist()


def future(spark, rows, horizon):
    from demandpanel.operators.calendar import future_calendar

    return future_calendar(rows, horizon, "MS")


def test_the_fold_equals_the_chain(spark, rows, monkeypatch):
    """Linear and boosted models side by side: each recurses on its own predictions."""
    fitted = forecast.fit_label(rows, "mixed", SPEC)
    one = forecast.forecast_label(fitted, rows, future(spark, rows, 5), 5)
    want = {(r.unique_id, r.ds): r.y_pred for r in one.collect()}
    only = forecast.scorer

    def no_trees(name, model):
        return None if name == "gbt" else only(name, model)

    monkeypatch.setattr(forecast, "scorer", no_trees)
    other = forecast.forecast_label(fitted, rows, future(spark, rows, 5), 5, checkpoint_every=2)
    got = {(r.unique_id, r.ds): r.y_pred for r in other.collect()}
    assert set(got) == set(want) and len(want) == 30
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_the_plan_does_not_grow_with_the_horizon(spark, rows):
    fitted = forecast.fit_label(rows, "mixed", SPEC)

    def nodes(horizon):
        out = forecast.forecast_label(fitted, rows, future(spark, rows, 60), horizon)
        return len(out._jdf.queryExecution().optimizedPlan().toString().splitlines())

    assert nodes(1) == nodes(60)


def test_linear_backtest_runs_as_many_jobs_for_any_number_of_folds(spark, rows):
    spec = ModelSpec("l", (1,), {1: (RollingMean(3),)}, ("local_scale",), {"linear": LinearModel()})
    counted = []
    for windows in (2, 6):
        before = jobs(spark)
        out = forecast.backtest_label(rows, "l", spec, windows, 3)
        counted.append(jobs(spark) - before)
        assert out.count() == 6 * windows * 3
    assert counted[0] == counted[1]


def test_folds_that_cannot_be_fitted(panel):
    spec = ModelSpec("l", (1,), {1: (RollingMean(3),)}, (), {"linear": LinearModel()})
    short = panel({"a": [1.0, 2.0, 4.0, 3.0, 5.0, 9.0], "b": [2.0, 1.0, 4.0, 4.0, 6.0, 1.0]})
    with pytest.warns(UserWarning, match="no training rows in fold 0"):
        out = forecast.backtest_label(panel({"a": [float(i % 5) for i in range(10)]}), "l", spec, 2, 5)
    assert out is not None and out.count() == 5
    with pytest.raises(ValueError, match="long enough"):
        forecast.backtest_label(short, "l", spec, 2, 2)


def test_tasks_run_side_by_side_in_their_pools(spark):
    pools, gate = {}, threading.Barrier(3, timeout=20)

    def task(name):
        def run():
            gate.wait()  # passes only if all three are running
            pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
            return spark.range(10).count()

        return run

    out = forecast.together({n: task(n) for n in "abc"}, 3)
    assert out == dict.fromkeys("abc", 10) and pools == {n: n for n in "abc"}
    assert forecast.together({"a": lambda: 1, "b": lambda: 2}, 1) == {"a": 1, "b": 2}
    with pytest.raises(RuntimeError, match="no fit"):

        def fail():
            time.sleep(0.1)
            raise RuntimeError("no fit")

        forecast.together({"a": fail, "b": lambda: 2}, 2)


def test_subsamples_do_not_depend_on_files(spark, rows):
    """The same series in other partitions and another order give the same trees."""
    spec = ModelSpec("t", (1, 2), {}, (), {"gbt": TreeModel("gbt", trees=3, depth=3, subsample=0.5)})
    dealt = rows.orderBy(F.desc("ds")).repartition(7)
    models = [forecast.fit_label(r, "t", spec, partitions=3).models["gbt"] for r in (rows, dealt)]
    assert models[0].toDebugString.split("\n", 1)[1] == models[1].toDebugString.split("\n", 1)[1]
