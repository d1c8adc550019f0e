"""One global model per label: fit, recursive forecast, backtest, importance.

A series is one row for forecasting: its history as an array, the last transformed
values and running statistics as state. Each step builds the lag features from that
state, scores them and updates the state. With models that are expressions (linear ones and
trees) the steps are one fold, whose plan is the same for any horizon; others are scored
by Spark ML in a chain of projections. Neither shuffles between the steps.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandpanel.functions.columns import (
    ID, LABEL, TARGET, TIME, by_series, in_time, require_columns, row_mean,
)
from demandpanel.functions.frequency import Frequency
from demandpanel.functions.scoring import (
    LinearFit, Scorer, least_squares, linear_scorer, numbers, scorer,
)
from demandpanel.functions.spec import (
    DIFFERENCE, SCALE, ExpandingStd, ExponentialMean, LinearModel, ModelSpec, RollingMean,
    TreeModel,
)
from demandpanel.operators.decompose import (
    FEATURES, components, explode_rows, series_rows, with_ahead,
)
from demandpanel.operators.features import TRANSFORMED, lag_features, scale_of
from demandpanel.sources.checkpoints import ensure_checkpoint_dir

BACKTEST_SCHEMA = (
    "unique_id string, ds date, cutoff date, y double, y_pred double, classification string"
)
FORECAST_SCHEMA = "unique_id string, ds date, y_pred double"
IMPORTANCE_SCHEMA = "classification string, model string, feature_name string, importance double"


# --- Estimators -------------------------------------------------------------------


def _boosted_trees(model: TreeModel) -> Estimator:
    return GBTRegressor(
        featuresCol="features",
        labelCol=TRANSFORMED,
        maxIter=model.trees,
        maxDepth=model.depth,
        stepSize=model.rate,
        subsamplingRate=model.subsample,
        seed=model.seed,
        maxMemoryInMB=512,
        # A reliable checkpoint per ten trees keeps lineage and recovery short.
        checkpointInterval=10,
    )


# Builder per model kind; add an entry to plug in another Spark ML regressor.
ESTIMATORS: dict[str, Callable[[TreeModel], Estimator]] = {
    "lgbm": _boosted_trees,
    "xgb": _boosted_trees,
    "gbt": _boosted_trees,
}


def build_estimator(model: TreeModel) -> Estimator:
    """The Spark ML estimator of a model; linear models need none."""
    if model.kind not in ESTIMATORS:
        raise ValueError(f"Unknown model kind {model.kind!r}; known: {sorted(ESTIMATORS)}")
    return ESTIMATORS[model.kind](model)


# --- Fitting ----------------------------------------------------------------------


@dataclass(frozen=True)
class FittedLabel:
    """Fitted models of one label with what is needed to build their features."""

    label: str
    spec: ModelSpec
    exogenous: tuple[str, ...]
    static: tuple[str, ...]
    text: tuple[str, ...]
    models: Mapping[str, Model | LinearFit]

    @property
    def feature_names(self) -> list[str]:
        return [*self.static, *self.exogenous, *self.spec.lag_features()]


def _code(column: str) -> str:
    return f"{column}__code"


def _feature_vector(features: Sequence[str]) -> Column:
    """SQL expressions as one vector; a missing feature is NaN, which trees send to one side."""
    values = [f"coalesce(cast({f} as double), double('NaN'))" for f in features]
    return array_to_vector(F.expr(f"array({', '.join(values)})"))


def _with_codes(df: DataFrame, text: Sequence[str]) -> DataFrame:
    """Hash string statics: the same code at any size, with no index on the driver."""
    # 53 bits are exact in a double.
    codes = {_code(c): F.shiftrightunsigned(F.xxhash64(c), 11).cast("double") for c in text}
    return df.withColumns(codes)


def _static_name(columns: Sequence[str], column: str) -> str:
    return f"`{_code(column)}`" if _code(column) in columns else f"`{column}`"


def together(tasks: Mapping[str, Callable[[], object]], at_once: int) -> dict:
    """Results of tasks that submit jobs, ``at_once`` of them side by side.

    Each runs in a scheduler pool of its own name, so that under fair scheduling the stages of a
    short fit are not kept waiting by a long one. The first error is raised.
    """
    spark = SparkSession.active()

    def run(name: str, task: Callable[[], object]) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return task()

    if at_once < 2 or len(tasks) < 2:
        return {name: task() for name, task in tasks.items()}
    with ThreadPoolExecutor(min(at_once, len(tasks))) as pool:
        # Wrapped here, so that the thread inherits this thread's properties.
        started = {
            name: pool.submit(inheritable_thread_target(spark)(run), name, task)
            for name, task in tasks.items()
        }
        return {name: f.result() for name, f in started.items()}


def _matrix(
    rows: DataFrame, spec: ModelSpec, exogenous: Sequence[str], static: Sequence[str],
    keys: Sequence[str] = (ID,),
) -> tuple[DataFrame, list[str], tuple[str, ...]]:
    """Lag features with codes, the features as SQL names, and the static columns that were coded."""
    kinds = dict(rows.dtypes)
    text = tuple(c for c in static if kinds[c] == "string")
    matrix = _with_codes(lag_features(rows, spec, exogenous, static, keys=keys), text)
    features = [
        *[_static_name(matrix.columns, c) for c in static],
        *[f"`{c}`" for c in [*exogenous, *spec.lag_features()]],
    ]
    return matrix, features, text


def _is_linear(spec: ModelSpec) -> bool:
    return all(isinstance(m, LinearModel) and m.kind not in ESTIMATORS for m in spec.models.values())


def fit_label(
    rows: DataFrame,
    label: str,
    spec: ModelSpec,
    exogenous: Sequence[str] = (),
    static: Sequence[str] = (),
    at_once: int = 4,
    partitions: int | None = None,
) -> FittedLabel | None:
    """Fit the label's models on all its series; None where there are no rows.

    ``rows`` are the panel rows of this label. Linear models are solved from the sums of one
    aggregate. For others the matrix is kept, spilling to disk, while the models are fitted side by
    side, ``at_once`` of them. It is laid out by a hash of the series in ``partitions`` (by
    default as many as the session shuffles to) and sorted in each: which rows a tree's
    subsample holds then depends on the series and that number, not on files or sizes.
    """
    if rows.isEmpty():
        return None
    ensure_checkpoint_dir(rows.sparkSession)
    too_short = f"No series labelled {label} is long enough for the features of {spec.name}"
    if _is_linear(spec):
        matrix, features, text = _matrix(rows, spec, exogenous, static)
        fits = least_squares(matrix, features, TRANSFORMED, _penalties(spec))
        if not fits:
            raise ValueError(too_short)
        return FittedLabel(label, spec, tuple(exogenous), tuple(static), text, fits)
    parts = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    matrix, features, text = _matrix(rows.repartition(parts, ID), spec, exogenous, static)
    kept = matrix.select(TRANSFORMED, _feature_vector(features).alias("features"))
    kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if kept.isEmpty():
            raise ValueError(too_short)
        linear = {n: m for n, m in spec.models.items() if m.kind not in ESTIMATORS and isinstance(m, LinearModel)}
        fits = {
            f"{label} {n}": (lambda m=m: build_estimator(m).fit(kept))
            for n, m in spec.models.items()
            if n not in linear
        }
        models = together(fits, at_once)
    finally:
        kept.unpersist()
    solved = least_squares(matrix, features, TRANSFORMED, _penalties(spec)) if linear else {}
    named = {n: solved[n] if n in linear else models[f"{label} {n}"] for n in spec.models}
    return FittedLabel(label, spec, tuple(exogenous), tuple(static), text, named)


def _penalties(spec: ModelSpec) -> dict[str, float]:
    return {n: m.penalty for n, m in spec.models.items() if isinstance(m, LinearModel)}


# --- Recursive forecast -----------------------------------------------------------


def _add_moment(s: str, v: str) -> str:
    """SQL for a moments struct ``s`` (count, mean, squared deviations) grown by ``v``."""
    return (
        f"if({v} is null, {s}, named_struct('n', {s}.n + 1, "
        f"'mean', {s}.mean + ({v} - {s}.mean) / ({s}.n + 1), "
        f"'m2', {s}.m2 + ({v} - {s}.mean) * ({v} - {s}.mean) * {s}.n / ({s}.n + 1)))"
    )


def _moments(values: str) -> str:
    """SQL for the moments of an array, nulls skipped."""
    zero = "named_struct('n', 0D, 'mean', 0D, 'm2', 0D)"
    return f"aggregate({values}, {zero}, (s, v) -> {_add_moment('s', 'v')})"


def _tail_length(spec: ModelSpec) -> int:
    """How many past values the next period's features reach back."""
    reach = (
        lag + (t.size - 1 if isinstance(t, RollingMean) else 0)
        for lag, t in spec.lag_features().values()
    )
    return max(reach, default=1)


def _transformed(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Add ``_z``, the transformed history array, and what inverts the transforms."""
    out = df.withColumn("_z", F.expr(f"transform(history, r -> r.{TARGET})"))
    out = out.withColumn("_level", F.element_at("_z", -1))
    for name in spec.target_transforms:
        if name == DIFFERENCE:
            # The longer array pads the shorter one with nulls; the last pair is cut off.
            before = "concat(array(cast(null as double)), _z)"
            changes = f"slice(zip_with(_z, {before}, (v, w) -> v - w), 1, size(_z))"
            out = out.withColumn("_z", F.expr(changes))
        elif name == SCALE:
            out = out.withColumn("_moments", F.expr(_moments("_z")))
            std = F.expr("sqrt(_moments.m2 / greatest(_moments.n, 1D))")
            out = out.withColumns({"_centre": F.col("_moments.mean"), "_scale": scale_of(std)})
            scaled = F.expr("transform(_z, v -> (v - _centre) / _scale)")
            out = out.withColumn("_z", scaled).drop("_moments")
    return out


def _to_target(spec: ModelSpec, z: str, level: str) -> str:
    """SQL that undoes the target transforms of one prediction, last transform first."""
    value = z
    for name in reversed(spec.target_transforms):
        value = f"({value} * _scale + _centre)" if name == SCALE else f"({value} + {level})"
    return value


def _initial_state(df: DataFrame, fitted: FittedLabel) -> DataFrame:
    """One state struct per model: recent values, level, running statistics, predictions.

    ``tail`` always has the same length, padded with nulls in front, so that every
    feature sits at a fixed place.
    """
    spec = fitted.spec
    keep = _tail_length(spec)
    padded = f"concat(array_repeat(cast(null as double), {keep}), _z)"
    fields = {
        "tail": f"slice({padded}, -{keep}, {keep})",
        "level": "_level",
        "done": "cast(array() as array<double>)",
    }
    for name, (lag, t) in spec.lag_features().items():
        seen = f"slice(_z, 1, greatest(size(_z) - {lag - 1}, 0))"
        if isinstance(t, ExpandingStd):
            fields[name] = _moments(seen)
        elif isinstance(t, ExponentialMean):
            known = f"filter({seen}, v -> v is not null)"
            fields[name] = (
                f"aggregate({known}, get({known}, 0), (m, v) -> m + {t.alpha}D * (v - m))"
            )
    kept = [c for c in df.columns if c not in ("_z", "_level", "history")]
    state = F.expr(_struct(fields))
    return df.select(*kept, *[state.alias(_state(m)) for m in fitted.models])


def _state(model: str) -> str:
    return f"_state_{model}"


def _struct(fields: Mapping[str, str]) -> str:
    entries = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return f"named_struct({entries})"


def _state_feature(spec: ModelSpec, state: str, name: str, lag: int, t) -> str:
    """SQL for one lag feature of the next period."""
    keep = _tail_length(spec)
    if t is None:
        return f"{state}.tail[{keep - lag}]"
    if isinstance(t, RollingMean):
        recent = f"slice({state}.tail, {keep - lag - t.size + 2}, {t.size})"
        known = f"filter({recent}, v -> v is not null)"
        total = f"aggregate({known}, 0D, (a, v) -> a + v)"
        return f"if(size({known}) >= {t.needed}, {total} / size({known}), null)"
    if isinstance(t, ExpandingStd):
        m = f"{state}.{name}"
        return f"if({m}.n > 1, sqrt({m}.m2 / ({m}.n - 1)), null)"
    return f"{state}.{name}"


def _next_state(spec: ModelSpec, state: str, z: str) -> str:
    """SQL for the state after predicting ``z``."""
    keep = _tail_length(spec)
    value = _to_target(spec, z, f"{state}.level")
    fields = {
        "tail": f"slice(concat({state}.tail, array({z})), 2, {keep})",
        "level": value,
        "done": f"concat({state}.done, array({value}))",
    }
    for name, (lag, t) in spec.lag_features().items():
        # The value that comes into view of this lag at the next period.
        entering = z if lag == 1 else f"{state}.tail[{keep - lag + 1}]"
        old = f"{state}.{name}"
        if isinstance(t, ExpandingStd):
            fields[name] = _add_moment(old, entering)
        elif isinstance(t, ExponentialMean):
            fields[name] = f"coalesce({old} + {t.alpha}D * ({entering} - {old}), {entering}, {old})"
    return _struct(fields)


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _fold(fitted: FittedLabel, model: str, how: Scorer, columns: Sequence[str], horizon: int) -> str:
    """SQL for all predictions of one model: a fold over the steps, each on its own predictions."""
    spec = fitted.spec
    outside = [
        *[_static_name(columns, c) for c in fitted.static],
        *[f"ahead[step].`{c}`" for c in fitted.exogenous],
    ]
    inside = [_state_feature(spec, "now", n, lag, t) for n, (lag, t) in spec.lag_features().items()]
    values = [f"coalesce(cast({f} as double), double('NaN'))" for f in [*outside, *inside]]
    after = _next_state(spec, "now", "predicted")
    known = f"array({', '.join(values)})" if values else "cast(array() as array<double>)"
    body = _let(known, "known", _let(how.sql("known"), "predicted", after))
    steps = f"sequence(0, {horizon - 1})"
    return f"aggregate({steps}, {_state(model)}, (now, step) -> {body}, ended -> ended.done)"


def _predict_series(
    series: DataFrame,
    fitted: FittedLabel,
    horizon: int,
    checkpoint_every: int | None = None,
    scorers: Mapping[str, Scorer] | None = None,
) -> DataFrame:
    """Add ``y_pred``, an array of ``horizon`` predictions averaged over the models.

    ``series`` has one row per series: ``history`` (sorted structs with ``y``),
    ``ahead`` (the next periods with their exogenous values) and static columns.
    """
    df = _with_codes(series, fitted.text)
    df = _initial_state(_transformed(df, fitted.spec), fitted)
    columns = df.columns
    how = scorers or {name: scorer(name, m) for name, m in fitted.models.items()}
    for name, one in how.items():
        if one:
            df = df.withColumns(one.columns)
            done = F.expr(_fold(fitted, name, one, columns, horizon))
            df = df.withColumn(f"_done_{name}", done).drop(*one.columns)
    others = {name: m for name, m in fitted.models.items() if not how[name]}
    if others:
        df = _chain(df, fitted, others, horizon, checkpoint_every)
    done = [F.col(f"_done_{name}") if how[name] else F.col(f"{_state(name)}.done") for name in fitted.models]
    steps = F.transform(
        F.sequence(F.lit(0), F.lit(horizon - 1)), lambda i: row_mean([F.get(d, i) for d in done])
    )
    return df.withColumn("y_pred", steps)


def _chain(
    df: DataFrame, fitted: FittedLabel, models: Mapping[str, Model], horizon: int, checkpoint_every: int | None
) -> DataFrame:
    """The states after ``horizon`` steps of models that Spark ML scores: a projection a step."""
    columns = df.columns
    spec, lagged = fitted.spec, fitted.spec.lag_features().items()
    for step in range(horizon):
        outside = [
            *[_static_name(columns, c) for c in fitted.static],
            *[f"ahead[{step}].`{c}`" for c in fitted.exogenous],
        ]
        for name, model in models.items():
            state = _state(name)
            inside = [_state_feature(spec, state, n, lag, t) for n, (lag, t) in lagged]
            df = model.transform(df.withColumn("features", _feature_vector([*outside, *inside])))
            # Each model recurses on its own predictions.
            after = F.expr(_next_state(spec, state, "prediction")).alias(state)
            df = df.select(*[after if c == state else c for c in columns])
        if checkpoint_every and (step + 1) % checkpoint_every == 0 and step + 1 < horizon:
            ensure_checkpoint_dir(df.sparkSession)
            df = df.checkpoint()
    return df


def _with_history(series: DataFrame, static: Sequence[str]) -> DataFrame:
    """Name the ``rows`` array and take the static values of its last entry."""
    last = F.element_at("rows", -1)
    return series.withColumns(
        {"history": F.col("rows"), **{c: last[c] for c in static}}
    ).drop("rows")


def _forecast_rows(
    fitted: FittedLabel, series: DataFrame, horizon: int, checkpoint_every: int | None
) -> DataFrame:
    rows = _with_history(series, fitted.static)
    predicted = _predict_series(rows, fitted, horizon, checkpoint_every)
    steps = predicted.withColumn("ahead", F.slice("ahead", 1, horizon))
    pairs = explode_rows(F.arrays_zip("ahead", "y_pred"))
    return steps.select(ID, pairs.alias("r")).select(
        ID, F.col(f"r.ahead.{TIME}").alias(TIME), F.col("r.y_pred").alias("y_pred")
    )


def _check_forecast(fitted: FittedLabel | None, horizon: int) -> None:
    if fitted is None:
        raise ValueError("The model is not fitted")
    if horizon <= 0:
        raise ValueError("horizon must be > 0")


def forecast_label(
    fitted: FittedLabel,
    rows: DataFrame,
    future: DataFrame,
    horizon: int,
    checkpoint_every: int | None = None,
) -> DataFrame:
    """``unique_id, ds, y_pred`` for the next ``horizon`` periods of the label's series.

    ``rows`` is the history of this label, ``future`` holds the coming periods of at
    least its series with the exogenous columns. Both become one row per series before
    they are joined. Only models that Spark ML must score make a plan that grows with the
    horizon: for those ``checkpoint_every`` cuts it after every so many steps, which runs jobs.
    """
    _check_forecast(fitted, horizon)
    require_columns(future, [ID, TIME, *fitted.exogenous])
    coming = series_rows(future, list(fitted.exogenous)).withColumnRenamed("rows", "ahead")
    short = F.raise_error(F.concat(F.lit("Too few future rows for series "), F.col(ID)))
    # A left join: a series without any future rows is an error, too.
    series = series_rows(rows, [TARGET, *fitted.static]).join(coming, ID, "left")
    series = series.where(
        F.when(F.size("ahead") >= horizon, F.lit(True)).otherwise(short.cast("boolean"))
    )
    return _forecast_rows(fitted, series, horizon, checkpoint_every)


def forecast_label_ahead(
    fitted: FittedLabel,
    rows: DataFrame,
    horizon: int,
    freq: str | Frequency,
    season_length: int,
    last: DataFrame,
    checkpoint_every: int | None = None,
) -> DataFrame:
    """``forecast_label`` on the future trend and seasonal values of the same history.

    History and future come from one array per series, so nothing is joined.
    """
    _check_forecast(fitted, horizon)
    unknown = [c for c in fitted.exogenous if c not in FEATURES]
    if unknown:
        raise ValueError(f"No future values for {unknown}; give forecast_label a future frame")
    series = series_rows(rows, [TARGET, *fitted.static])
    series = with_ahead(series, season_length, horizon, freq, last)
    return _forecast_rows(fitted, series, horizon, checkpoint_every)


# --- Backtest ---------------------------------------------------------------------


def cv_folds(df: DataFrame, windows: int, periods: int) -> DataFrame:
    """Each fold's rows: ``fold`` (0 = oldest), ``part`` (train or test) and ``cutoff``.

    Fold ``i`` of ``n`` tests the ``periods`` rows that end ``(n-1-i) * periods`` rows
    before the end of the series and trains on everything earlier. A series without
    training rows in a fold is not in it.
    """
    _check_folds(windows, periods)
    columns = df.columns
    back = F.row_number().over(in_time())
    total = F.count(F.lit(1)).over(by_series())
    placed = df.select("*", (total - back + 1).alias("_back"))
    # How many rows before the end of the series each fold's training part stops.
    folds = F.explode(F.sequence(F.lit(0), F.lit(windows - 1)))
    rows = placed.select("*", folds.alias("fold"))
    held_back = (F.lit(windows) - F.col("fold")) * periods
    is_train = F.col("_back") > held_back
    is_test = (F.col("_back") <= held_back) & (F.col("_back") > held_back - periods)
    part = F.when(is_train, "train").when(is_test, "test")
    return _with_cutoff(rows.withColumn("part", part).where(F.col("part").isNotNull()), columns)


def _with_cutoff(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    fold = Window.partitionBy(ID, "fold")
    cutoff = F.max(F.when(F.col("part") == "train", F.col(TIME))).over(fold)
    return rows.withColumn("cutoff", cutoff).where(F.col("cutoff").isNotNull()).select(
        *columns, "fold", "part", "cutoff"
    )


def _check_folds(windows: int, periods: int) -> None:
    if windows <= 0 or periods <= 0:
        raise ValueError("windows and periods must be > 0")


def _fold_series(
    series: DataFrame, windows: int, periods: int, fold: int | Column
) -> DataFrame:
    """Split each series' array into the fold's ``history`` and ``ahead``."""
    stop = F.size("rows") - (F.lit(windows) - fold) * periods
    split = series.withColumn("_stop", stop).where(F.col("_stop") > 0)
    return split.select(
        "*",
        F.slice("rows", 1, F.col("_stop")).alias("history"),
        F.slice("rows", F.col("_stop") + 1, periods).alias("ahead"),
    ).drop("rows", "_stop")


def _refit_features(
    folded: DataFrame, season_length: int, periods: int, columns: Sequence[str]
) -> DataFrame:
    """Replace trend and seasonal by what the fold's history alone gives."""
    targets = F.transform("history", lambda r: r[TARGET])
    parts = folded.withColumn("parts", components(targets, season_length, periods))

    def replaced(rows: str, offset: Column | int) -> Column:
        def entry(r: Column, i: Column) -> Column:
            new = {c: F.get(F.col(f"parts.{c}"), i + offset) for c in ("trend", "seasonal")}
            fields = [new.get(c, r[c]).alias(c) for c in columns]
            return F.struct(*fields)

        return F.transform(rows, entry)

    length = F.size("history")
    return parts.withColumns(
        {"ahead": replaced("ahead", length), "history": replaced("history", F.lit(0))}
    ).drop("parts")


def backtest_label(
    rows: DataFrame,
    label: str,
    spec: ModelSpec,
    windows: int,
    periods: int,
    exogenous: Sequence[str] = (),
    static: Sequence[str] = (),
    features: str = "as_given",
    season_length: int | None = None,
    at_once: int = 4,
) -> DataFrame | None:
    """Rolling-origin backtest of one label, refitted in every fold.

    Exogenous values are those of the panel (``as_given``), or trend and seasonal are
    recomputed from each fold's history (``per_fold``, needs ``season_length``). Series
    become arrays once; every fold is a slice of them. Linear models of all folds are solved from one
    aggregate by fold; others are fitted side by side, ``at_once`` folds of them.
    """
    _check_folds(windows, periods)
    if features not in ("as_given", "per_fold"):
        raise ValueError("features must be 'as_given' or 'per_fold'")
    if features == "per_fold" and not season_length:
        raise ValueError("features='per_fold' needs season_length")
    if rows.isEmpty():
        return None
    columns = [TIME, TARGET, *exogenous, *static]
    series = series_rows(rows, columns[1:])
    if not _is_linear(spec):  # every fold reads them, while it is fitted and in the result
        ensure_checkpoint_dir(rows.sparkSession)
        series = series.checkpoint()

    def folded(fold: int | Column) -> DataFrame:
        out = _fold_series(series, windows, periods, fold)
        return _refit_features(out, season_length, periods, columns) if features == "per_fold" else out

    def train(out: DataFrame, *keys: str) -> DataFrame:
        return out.select(ID, *keys, explode_rows(F.col("history")).alias("r")).select(ID, *keys, "r.*")

    if _is_linear(spec):
        folds = F.explode(F.sequence(F.lit(0), F.lit(windows - 1)))
        series = series.withColumn("fold", folds)
        every = folded(F.col("fold"))
        matrix, names, text = _matrix(train(every, "fold"), spec, exogenous, static, keys=(ID, "fold"))
        fits = least_squares(matrix, names, TRANSFORMED, _penalties(spec), by="fold")
        lost = sorted(set(range(windows)) - set(fits))
        if lost:
            there = {r["fold"] for r in every.where(F.col("fold").isin(lost)).select("fold").distinct().collect()}
            _report_lost(label, spec, lost, there)
        if not fits:
            return None
        fitted = FittedLabel(label, spec, tuple(exogenous), tuple(static), text, dict.fromkeys(spec.models))
        scorers = {}
        for name in spec.models:
            by_fold = [(F.lit(k), numbers([f[name].intercept, *f[name].coefficients])) for k, f in fits.items()]
            values = F.element_at(F.create_map(*[c for pair in by_fold for c in pair]), F.col("fold"))
            scorers[name] = linear_scorer(name, len(names), values)
        known = every.where(F.col("fold").isin(list(fits)))
        return _fold_rows(known, fitted, label, periods, static, scorers)

    def fit(fold: int) -> FittedLabel | None:
        return fit_label(train(folded(fold)), label, spec, exogenous, static, 1)

    models = together({f"{label} fold {k}": (lambda k=k: fit(k)) for k in range(windows)}, at_once)
    out = None
    for fold in range(windows):
        fitted = models[f"{label} fold {fold}"]
        if fitted is None:
            _report_lost(label, spec, [fold], set())
            continue
        part = _fold_rows(folded(fold), fitted, label, periods, static)
        out = part if out is None else out.unionByName(part)
    return out


def _report_lost(label: str, spec: ModelSpec, lost: Sequence[int], there: set[int]) -> None:
    """Folds that no model could be fitted in: an error where they have rows, else a warning."""
    if there:
        raise ValueError(f"No series labelled {label} is long enough for the features of {spec.name}")
    for fold in lost:
        warnings.warn(f"{label}: no training rows in fold {fold}", stacklevel=3)


def _fold_rows(
    folded: DataFrame, fitted: FittedLabel, label: str, periods: int, static: Sequence[str],
    scorers: Mapping[str, Scorer] | None = None,
) -> DataFrame:
    """Held-out rows of folds with their predictions."""
    last = F.element_at("history", -1)
    folded = folded.withColumns({"cutoff": last[TIME], **{c: last[c] for c in static}})
    predicted = _predict_series(folded, fitted, periods, scorers=scorers)
    pairs = explode_rows(F.arrays_zip("ahead", "y_pred"))
    return predicted.select(ID, "cutoff", pairs.alias("r")).select(
        ID,
        F.col(f"r.ahead.{TIME}").alias(TIME),
        "cutoff",
        F.col(f"r.ahead.{TARGET}").alias(TARGET),
        F.col("r.y_pred").alias("y_pred"),
        F.lit(label).alias(LABEL),
    )


# --- Importance and persistence ---------------------------------------------------


def importance_label(spark: SparkSession, fitted: FittedLabel) -> DataFrame:
    """``classification, model, feature_name, importance``; importances of a model sum to one.

    Those of a linear model are the sizes of its coefficients.
    """
    rows = []
    for name, model in fitted.models.items():
        values = _importances(model)
        if len(values) != len(fitted.feature_names):
            raise ValueError(f"{name}: {len(values)} values for {fitted.feature_names}")
        rows += [
            (fitted.label, name, feature, float(v))
            for feature, v in zip(fitted.feature_names, values)
        ]
    return spark.createDataFrame(rows, IMPORTANCE_SCHEMA)


def _importances(model: Model | LinearFit) -> list[float]:
    if hasattr(model, "featureImportances"):
        return list(model.featureImportances.toArray())
    sizes = [abs(c) for c in model.coefficients]
    total = sum(sizes) or 1.0
    return [s / total for s in sizes]


def save_fitted(spark: SparkSession, fitted: FittedLabel | None, path: str) -> None:
    """Write models and a one-row description below ``path``."""
    if fitted is None:
        raise ValueError("An unfitted model cannot be saved")
    linear = {n: m for n, m in fitted.models.items() if isinstance(m, LinearFit)}
    for name, model in fitted.models.items():
        if name not in linear:
            model.write().overwrite().save(f"{path}/models/{name}")
    description = {
        "label": fitted.label,
        "spec": fitted.spec.to_dict(),
        "exogenous": fitted.exogenous,
        "static": fitted.static,
        "text": fitted.text,
        "linear": {n: asdict(m) for n, m in linear.items()},
        "classes": {
            name: f"{type(m).__module__}.{type(m).__name__}"
            for name, m in fitted.models.items()
            if name not in linear
        },
    }
    schema = T.StructType([T.StructField("value", T.StringType())])
    row = spark.createDataFrame([(json.dumps(description),)], schema)
    row.coalesce(1).write.mode("overwrite").text(f"{path}/description")


def load_fitted(spark: SparkSession, path: str) -> FittedLabel:
    """Read back what ``save_fitted`` wrote; only the description passes the driver."""
    data = json.loads(spark.read.text(f"{path}/description").first()["value"])
    models = {
        name: _model_class(kind).load(f"{path}/models/{name}")
        for name, kind in data["classes"].items()
    }
    linear = {n: LinearFit(tuple(m["coefficients"]), m["intercept"]) for n, m in data["linear"].items()}
    spec = ModelSpec.from_dict(data["spec"])
    models = {name: (models | linear)[name] for name in spec.models}
    return FittedLabel(
        data["label"],
        spec,
        tuple(data["exogenous"]),
        tuple(data["static"]),
        tuple(data["text"]),
        models,
    )


def _model_class(name: str) -> type[Model]:
    import importlib

    module, _, cls = name.rpartition(".")
    if not module.startswith("pyspark.ml."):
        raise ValueError(f"Not a Spark ML model class: {name}")
    return getattr(importlib.import_module(module), cls)
