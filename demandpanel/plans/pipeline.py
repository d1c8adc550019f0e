"""The user-level jobs: build the training table, forecast, backtest, explain."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandpanel.functions.columns import ID, LABEL, LABELS, TIME, require_columns, require_text
from demandpanel.functions.frequency import Frequency
from demandpanel.functions.spec import ModelSpec
from demandpanel.operators.calendar import (
    calendar_end, date_bounds, future_calendar, panel_size,
)
from demandpanel.operators.decompose import FEATURES, add_features, mstl_features, mstl_future
from demandpanel.operators.forecast import (
    BACKTEST_SCHEMA, FORECAST_SCHEMA, IMPORTANCE_SCHEMA, FittedLabel,
    backtest_label, fit_label, forecast_label, forecast_label_ahead, importance_label, together,
)
from demandpanel.operators.prepare import Classifier, CleaningObservation, prepare
from demandpanel.plans.policies import POLICIES, spec_for
from demandpanel.sources.tables import (
    inbound, read_future, read_table, read_training, replace_forecasts, require_rows,
    standardise, unique_keys, write_future, write_training,
)


def layout_by_series(df: DataFrame, column: str = ID, partitions: int | None = None) -> DataFrame:
    """Range-partition by series and sort each partition by series and date.

    For files that should be read in key order. The jobs here do not need it: their
    windows hash by series anyway, and adaptive execution sizes the partitions.
    """
    require_text("column", column)
    require_columns(df, [column, TIME])
    keys = [partitions, column] if partitions else [column]
    ranged = df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(column, TIME)


def training_frame(df: DataFrame, season_length: int, unique: bool = True) -> DataFrame:
    """History with trend and seasonal columns; set ``unique=False`` where keys may repeat."""
    return mstl_features(df if unique else inbound(df), season_length)


def future_frame(
    df: DataFrame,
    horizon: int,
    freq: str | Frequency,
    season_length: int,
    exogenous: Sequence[str] = FEATURES,
    last: DataFrame | None = None,
) -> DataFrame:
    """Future periods of every series with the features the model was trained on."""
    future = mstl_future(df, season_length, horizon, freq, last)
    require_columns(future, exogenous)
    return future.select(ID, TIME, *exogenous)


def future_features(
    df: DataFrame,
    horizon: int,
    freq: str | Frequency,
    features: Sequence[Callable[[DataFrame], DataFrame]],
) -> DataFrame:
    """Future periods of every series passed through exogenous-feature functions."""
    return add_features(future_calendar(df, horizon, freq), features)


def mstl_future_feature(
    history: DataFrame, season_length: int, horizon: int, freq: str | Frequency
) -> Callable[[DataFrame], DataFrame]:
    """Trend and seasonal as a feature function for ``future_features``."""

    def feature(future: DataFrame) -> DataFrame:
        return future.join(mstl_future(history, season_length, horizon, freq), [ID, TIME], "left")

    return feature


def load_for_forecast(
    spark: SparkSession,
    source: str,
    exogenous: Sequence[str],
    horizon: int,
    freq: str | Frequency,
    season_length: int,
    static: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The training table and the future frame that continues it."""
    training = read_training(spark, source, exogenous, static)
    return training, future_frame(training, horizon, freq, season_length, exogenous)


def build_training_table(
    spark: SparkSession,
    source: str,
    table: str,
    id_column: str,
    time_column: str,
    target_column: str,
    freq: str | Frequency,
    season_length: int,
    inactivity: int,
    min_records: int,
    exogenous: Sequence[str] = FEATURES,
    static: Sequence[str] | None = None,
    on_duplicate: str = "error",
    mode: str = "strict",
    partition_by_label: bool = False,
    buckets: int | None = None,
    features: Sequence[Callable[[DataFrame], DataFrame]] = (),
    report: CleaningObservation | None = None,
    classify: Classifier | None = None,
) -> DataFrame:
    """Read raw series, prepare and decompose them, overwrite the training table, return it.

    ``features`` add further exogenous columns; trend and seasonal are computed where ``exogenous``
    names them. ``report`` gathers the counts of the cleaning while the table is written. The panel is
    laid out in as many partitions as its size asks for, at least ``buckets``.
    """
    raw = read_table(spark, source)
    rows = standardise(raw, id_column, time_column, target_column, static, mode)
    size, bounds = panel_size(rows, freq)
    partitions = max(size, buckets or 1)
    partitions = partitions if partitions > 1 else None
    prepared = prepare(
        unique_keys(rows, on_duplicate, partitions), freq, inactivity, min_records, list(static or []),
        bounds=bounds, report=report, classify=classify, partitions=partitions,
    )
    decomposed = training_frame(prepared, season_length) if set(FEATURES) & set(exogenous) else prepared
    write_training(
        add_features(decomposed, features), table, exogenous, static, partition_by_label, buckets
    )
    return read_training(spark, table, exogenous, static)


def build_future_table(
    spark: SparkSession,
    training: str,
    table: str,
    freq: str | Frequency,
    season_length: int,
    horizon: int,
    exogenous: Sequence[str] = FEATURES,
    features: Sequence[Callable[[DataFrame], DataFrame]] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Overwrite the table of the periods that follow a training table, return it.

    ``features`` are those that the training table was built with. Give both tables the same
    ``buckets``: ``forecast_table`` then joins them without a shuffle.
    """
    history = read_training(spark, training, ())
    if set(FEATURES) & set(exogenous):
        coming = mstl_future(history, season_length, horizon, freq)
    else:
        coming = future_calendar(history, horizon, freq)
    write_future(add_features(coming, features), table, exogenous, buckets)
    return read_future(spark, table, exogenous)


def train_test_future(
    spark: SparkSession,
    source: str,
    id_column: str,
    time_column: str,
    target_column: str,
    split_date: datetime.date | str,
    horizon: int,
    freq: str | Frequency,
    season_length: int,
    inactivity: int,
    min_records: int,
    static: Sequence[str] | None = None,
    on_duplicate: str = "error",
    check: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training rows with features, untouched test rows, and the future after training.

    The date split is a filter on the raw column, so each side scans only its own part
    of the files where statistics allow it. With ``check`` a side without rows raises when it is read.
    """
    raw = read_table(spark, source)
    side = partial(standardise, raw, id_column, time_column, target_column, static)
    before, after = side(until=split_date), side(after=split_date)
    bounds = date_bounds(before)
    if check:
        before, after = require_rows(before, "train"), require_rows(after, "test")
    prepared = prepare(
        unique_keys(before, on_duplicate), freq, inactivity, min_records, list(static or []),
        bounds=bounds,
    )
    return (
        training_frame(prepared, season_length),
        unique_keys(after, on_duplicate),
        # Every filled series ends with the calendar, so the panel is not planned again for its end.
        future_frame(prepared, horizon, freq, season_length, last=calendar_end(bounds, freq)),
    )


def _label_rows(training: DataFrame, label: str) -> DataFrame:
    return training.where(F.col(LABEL) == label).drop(LABEL)


def _union(spark: SparkSession, parts: Sequence[DataFrame], schema: str) -> DataFrame:
    """All parts under one schema; an empty frame where there are none."""
    out = spark.createDataFrame([], schema)
    if not parts:
        return out
    columns = out.columns
    out = parts[0].select(*columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*columns))
    return out


def fit_all(
    training: DataFrame,
    exogenous: Sequence[str] = FEATURES,
    static: Sequence[str] | None = None,
    policies: Mapping[str, ModelSpec] = POLICIES,
    at_once: int = 4,
) -> dict[str, FittedLabel]:
    """Fit every label that has rows; ``at_once`` labels, and models of a label, side by side.

    A boosted tree is a chain of short jobs that leave a cluster idle between them, so fits fill
    each other's gaps. Each label's matrix is kept while it is fitted: 1 bounds that to one.
    """

    def fit(label: str) -> FittedLabel | None:
        spec = policies[label] if label in policies else spec_for(label)
        return fit_label(_label_rows(training, label), label, spec, exogenous, list(static or []), at_once)

    labels = dict.fromkeys([*LABELS, *policies])
    fitted = together({label: (lambda label=label: fit(label)) for label in labels}, at_once)
    return {label: model for label, model in fitted.items() if model is not None}


def forecast_all(
    training: DataFrame,
    freq: str | Frequency,
    season_length: int,
    horizon: int,
    exogenous: Sequence[str] = FEATURES,
    static: Sequence[str] | None = None,
    policies: Mapping[str, ModelSpec] = POLICIES,
    fitted: Mapping[str, FittedLabel] | None = None,
    future: DataFrame | None = None,
) -> DataFrame:
    """``unique_id, ds, y_pred`` for all labels; fits the models unless given.

    The future values of trend and seasonal follow from the history; models with other
    exogenous columns need a ``future`` frame that has them.
    """
    if horizon <= 0:
        raise ValueError("horizon must be > 0")
    if fitted is None:
        fitted = fit_all(training, exogenous, static, policies)
    last = date_bounds(training)
    parts = []
    for label, model in fitted.items():
        rows = _label_rows(training, label)
        if future is None:
            parts.append(forecast_label_ahead(model, rows, horizon, freq, season_length, last))
        else:
            parts.append(forecast_label(model, rows, future, horizon))
    return _union(training.sparkSession, parts, FORECAST_SCHEMA)


def forecast_table(
    spark: SparkSession,
    source: str,
    output: str,
    version: str,
    freq: str | Frequency,
    season_length: int,
    horizon: int,
    exogenous: Sequence[str] = FEATURES,
    static: Sequence[str] | None = None,
    policies: Mapping[str, ModelSpec] = POLICIES,
    future: str | DataFrame | None = None,
) -> DataFrame:
    """Forecast a stored training table as one version of the forecast table; returns that version.

    Forecasts that the version had are replaced, so the job can be run again. ``future`` is a
    table or frame of the coming periods with the exogenous columns (``build_future_table``).
    """
    require_text("version", version)
    training = read_training(spark, source, exogenous, static)
    if isinstance(future, str):
        future = read_future(spark, future, exogenous)
    forecasts = forecast_all(
        training, freq, season_length, horizon, exogenous, static, policies, future=future
    )
    replace_forecasts(forecasts, version, output)
    return spark.table(output).where(F.col("version") == version)


def backtest_all(
    training: DataFrame,
    windows: int,
    periods: int,
    exogenous: Sequence[str] = FEATURES,
    static: Sequence[str] | None = None,
    policies: Mapping[str, ModelSpec] = POLICIES,
    features: str = "as_given",
    season_length: int | None = None,
    at_once: int = 4,
) -> DataFrame:
    """``unique_id, ds, cutoff, y, y_pred, classification`` over all labels and folds."""

    def backtest(label: str) -> DataFrame | None:
        spec = policies[label] if label in policies else spec_for(label)
        return backtest_label(
            _label_rows(training, label), label, spec, windows, periods, exogenous,
            list(static or []), features, season_length, at_once,
        )

    labels = dict.fromkeys([*LABELS, *policies])
    parts = together({label: (lambda label=label: backtest(label)) for label in labels}, at_once)
    return _union(training.sparkSession, [p for p in parts.values() if p is not None], BACKTEST_SCHEMA)


def importance_all(
    training: DataFrame,
    exogenous: Sequence[str] = FEATURES,
    static: Sequence[str] | None = None,
    policies: Mapping[str, ModelSpec] = POLICIES,
    fitted: Mapping[str, FittedLabel] | None = None,
) -> DataFrame:
    """``classification, model, feature_name, importance`` of every fitted model."""
    if fitted is None:
        fitted = fit_all(training, exogenous, static, policies)
    spark = training.sparkSession
    parts = [importance_label(spark, model) for model in fitted.values()]
    return _union(spark, parts, IMPORTANCE_SCHEMA)
