"""Queries over the given tables, one or more per operator."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandpanel.functions.columns import by_series, in_time, row_mean
from demandpanel.functions.spec import LinearModel, ModelSpec
from demandpanel.operators import calendar as cal
from demandpanel.operators import (
    classify, clean, decompose, features, forecast, harmonics, impute,
)
from demandpanel.operators.prepare import CleaningObservation
from demandpanel.plans import pipeline
from demandpanel.plans.policies import POLICIES, spec_for
from demandpanel.sources import tables
from registry import panels
from registry.oracle import INACTIVITY, MIN_RECORDS, SPLIT

Query = Callable[[SparkSession, str], DataFrame]

# Registered model queries fit least squares on the last transformed value, with each
# label's own target transforms: SQL can express all of it. The policies' trees run for
# many minutes even on a small panel and are not registered.
LINEAR = {
    label: ModelSpec("linear", (1,), {}, spec.target_transforms, {"linear": LinearModel()})
    for label, spec in POLICIES.items()
}


def _r(name: str | Column, alias: str | None = None) -> Column:
    """Rounded double without negative zero."""
    column = F.col(name) if isinstance(name, str) else name
    return (F.round(column, 6) + F.lit(0.0)).alias(alias or name)


def _show(df: DataFrame, *extra: str) -> DataFrame:
    return df.select("unique_id", "ds", _r("y"), *extra)


def _on_panel(
    panel: Callable[[SparkSession, str], DataFrame],
    operator: Callable[[DataFrame], DataFrame],
    *extra: str,
) -> Query:
    return lambda spark, sf: _show(operator(panel(spark, sf)), *extra)


def _month_ends(panel: panels.Panel) -> panels.Panel:
    return replace(panel, rows=lambda spark, sf: panel.rows(spark, sf).withColumn("ds", F.last_day("ds")))


def _sized(rows: DataFrame, freq: str, at_least: int = 1) -> dict:
    """Bounds and partitions of a panel by its size, as arguments; none where one partition holds it."""
    size, bounds = cal.panel_size(rows, freq)
    partitions = max(size, at_least)
    return {"bounds": bounds, "partitions": partitions} if partitions > 1 else {}


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _laid_out(
    spark: SparkSession, sf: str, panel: panels.Panel, freq: str, at_least: int = 1
) -> tuple[DataFrame, dict]:
    """A panel whose rows are merged in partitions by its size, and ``_sized`` of it."""
    rows = panel.rows(spark, sf)
    sized = _sized(rows, freq, at_least)
    return panel.merged(rows, sized.get("partitions")), sized


def _fill(df: DataFrame, freq: str, static: Sequence[str] = ()) -> DataFrame:
    return cal.fill_calendar(df, freq, static, **_sized(df, freq))


def _filled(spark: SparkSession, sf: str, panel: panels.Panel, freq: str) -> DataFrame:
    df, sized = _laid_out(spark, sf, panel, freq)
    return cal.fill_calendar(df, freq, **sized)


def _on_filled(
    panel: panels.Panel, freq: str, operator: Callable[[DataFrame], DataFrame] = lambda df: df
) -> Query:
    return lambda spark, sf: _show(operator(_filled(spark, sf, panel, freq)))


def cleaned(spark: SparkSession, sf: str, panel: panels.Panel, freq: str = "MS") -> DataFrame:
    return clean.clean_series(_filled(spark, sf, panel, freq), INACTIVITY, MIN_RECORDS)


def prepared(
    spark: SparkSession, sf: str, panel: panels.Panel = panels.nation_segment, freq: str = "MS"
) -> DataFrame:
    df, sized = _laid_out(spark, sf, panel, freq)
    return pipeline.prepare(df, freq, INACTIVITY, MIN_RECORDS, **sized)


def training(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.training_frame(prepared(spark, sf), 12)


def _store(rows: DataFrame, exogenous: list[str], buckets: int | None = None) -> str:
    """Write a training frame as a table, by default with as many buckets as the session shuffles to."""
    table = f"training_{uuid.uuid4().hex}"
    buckets = buckets or _buckets(rows.sparkSession)
    tables.write_training(rows, table, exogenous, partition_by_label=True, buckets=buckets)
    return table


def _store_prepared(
    spark: SparkSession, sf: str, panel: Callable, report: CleaningObservation | None = None
) -> str:
    """Write a prepared panel as a table, with as many buckets as its size asks for."""
    df, sized = _laid_out(spark, sf, panel, "MS", max(2, _buckets(spark)))
    out = pipeline.prepare(df, "MS", INACTIVITY, MIN_RECORDS, report=report, **sized)
    return _store(out, [], sized["partitions"])


def _stored(spark: SparkSession, sf: str, panel: Callable) -> DataFrame:
    """A prepared panel as a table: model jobs read it many times."""
    return tables.read_training(spark, _store_prepared(spark, sf, panel), [])


# --- Sources ----------------------------------------------------------------------


def read_series_panel(spark: SparkSession, sf: str) -> DataFrame:
    return _show(
        tables.read_series(
            spark, f"{sf}/lineitem.parquet", "l_partkey", "l_shipdate", "l_quantity",
            on_duplicate="sum",
        )
    )


def read_series_first(spark: SparkSession, sf: str) -> DataFrame:
    return _show(
        tables.read_series(
            spark, f"{sf}/orders.parquet", "o_custkey", "o_orderdate", "o_totalprice",
            ["o_orderpriority"], on_duplicate="first",
        ),
        "o_orderpriority",
    )


def read_series_permissive(spark: SparkSession, sf: str) -> DataFrame:
    orders = panels.table(spark, sf, "orders")
    ranked = orders.withColumn("rank", F.substring("o_orderpriority", 1, 1))
    rows = tables.standardise(ranked, "o_custkey", "o_orderdate", "rank", mode="permissive")
    return tables.unique_keys(rows, "sum")


def read_series_unreadable(spark: SparkSession, sf: str) -> DataFrame:
    """Open orders have a number, others a letter, which is no target."""
    orders = panels.table(spark, sf, "orders")
    marked = orders.withColumn("mark", F.translate("o_orderstatus", "O", "7"))
    rows = tables.standardise(marked, "o_custkey", "o_orderdate", "mark", mode="permissive")
    return tables.unique_keys(rows, "sum")


def _split(side: int) -> Query:
    return lambda spark, sf: _show(tables.split_at(panels.part_month(spark, sf), SPLIT)[side])


def dedupe_keys(spark: SparkSession, sf: str) -> DataFrame:
    raw = panels.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("unique_id"), F.col("l_shipdate").alias("ds"),
        F.col("l_quantity").alias("y"),
    )
    return _show(tables.inbound(raw))


def panel_bounds(spark: SparkSession, sf: str) -> DataFrame:
    panel = panels.part_month(spark, sf)
    train, test = tables.split_at(panel, SPLIT)
    return tables.dataset_bounds(all=panel, train=train, test=test)


# --- Reports ----------------------------------------------------------------------


def cleaning_report(spark: SparkSession, sf: str) -> DataFrame:
    filled = _filled(spark, sf, panels.part_returns_nullable, "MS")
    return clean.cleaning_report(filled, clean.clean_series(filled, INACTIVITY, MIN_RECORDS))


def cleaning_report_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The counts of the cleaning, gathered while the prepared panel is written."""
    report = CleaningObservation()
    _store_prepared(spark, sf, panels.part_returns_nullable, report)
    return report.frame(spark)


def demand_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics = classify.demand_metrics(cleaned(spark, sf, panels.nation_segment))
    return metrics.select("unique_id", "classification", _r("adi"), _r("cv2"))


def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    metrics = classify.demand_metrics(cleaned(spark, sf, panels.part_month))
    return classify.class_distribution(metrics)


def class_dispersion(spark: SparkSession, sf: str) -> DataFrame:
    metrics = classify.demand_metrics(cleaned(spark, sf, panels.nation_segment))
    spread = classify.class_dispersion(metrics)
    return spread.select("classification", "n_series", *[_r(c) for c in spread.columns[2:]])


# --- Calendar ---------------------------------------------------------------------


def misaligned_series(spark: SparkSession, sf: str) -> DataFrame:
    return decompose.misaligned_series(panels.part_month(spark, sf))


def future_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return cal.future_calendar(panels.part_month(spark, sf), 6, "MS")


# --- Features ---------------------------------------------------------------------


def series_function(spark: SparkSession, sf: str) -> DataFrame:
    def running_total(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {"unique_id": key[0], "ds": rows["ds"], "total": rows["y"].cumsum().round(6)}
        )

    return decompose.apply_per_series(
        panels.supplier_month(spark, sf), running_total, "unique_id string, ds date, total double"
    )


def target_difference(spark: SparkSession, sf: str) -> DataFrame:
    out = features.difference(panels.supplier_month(spark, sf))
    return _show(out, _r("z"))


def target_local_scale(spark: SparkSession, sf: str) -> DataFrame:
    return _show(features.local_scale(panels.supplier_month(spark, sf)), _r("z"))


def _lag_features(label: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = prepared(spark, sf).where(F.col("classification") == label)
        matrix = features.lag_features(rows, spec_for(label))
        return matrix.select("unique_id", "ds", *[_r(c) for c in matrix.columns[2:]])

    return query


SEASONS = {12: 2, 4: 2}


def harmonic_features(spark: SparkSession, sf: str) -> DataFrame:
    """Sine and cosine of two seasons, on the months of the panel."""
    out = harmonics.harmonic_features("MS", SEASONS)(panels.part_month(spark, sf))
    return _show(out, *[_r(c) for c in harmonics.harmonic_names(SEASONS)])


def mstl_train_features(spark: SparkSession, sf: str) -> DataFrame:
    return training(spark, sf)


def mstl_future_features(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.future_frame(prepared(spark, sf), 6, "MS", 12)


def future_features(spark: SparkSession, sf: str) -> DataFrame:
    history = prepared(spark, sf)
    trend = pipeline.mstl_future_feature(history, 12, 6, "MS")
    return pipeline.future_features(history, 6, "MS", [trend])


# --- Models -----------------------------------------------------------------------


def ensemble_mean(spark: SparkSession, sf: str) -> DataFrame:
    panel = panels.part_returns_nullable(spark, sf)
    both = panel.withColumn("b", F.lag("y").over(in_time()))
    return both.select("unique_id", "ds", _r(row_mean([F.col("y"), F.col("b")]), "y_pred"))


def cv_folds(spark: SparkSession, sf: str) -> DataFrame:
    folds = forecast.cv_folds(panels.supplier_month(spark, sf), 3, 4)
    return _show(folds, "fold", "part", "cutoff")


def _money(df: DataFrame, *predictions: str) -> DataFrame:
    """Predictions to the cent: amounts of a million carry no more digits through the sums."""
    cents = {c: F.round(c, 2) + F.lit(0.0) for c in predictions or ("y_pred",)}
    return df.withColumns(cents)


def _forecast(panel: Callable, horizon: int) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = _stored(spark, sf, panel)
        return _money(pipeline.forecast_all(rows, "MS", 12, horizon, (), policies=LINEAR))

    return query


def _backtest(panel: Callable, windows: int, periods: int) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = _stored(spark, sf, panel)
        out = pipeline.backtest_all(rows, windows, periods, (), policies=LINEAR)
        return _money(out).withColumn("y", _r("y"))

    return query


def forecast_own_future(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts on a future frame that is joined, instead of one made from the history."""
    rows = _stored(spark, sf, panels.supplier_month)
    future = cal.future_calendar(rows, 6, "MS")
    return _money(
        pipeline.forecast_all(rows, "MS", 12, 6, (), policies=LINEAR, future=future)
    )


def _importance(panel: Callable) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        out = pipeline.importance_all(_stored(spark, sf, panel), (), policies=LINEAR)
        return out.withColumn("importance", F.round("importance", 6))

    return query


def model_save_load(
    spark: SparkSession, sf: str, panel: Callable = panels.nation_segment
) -> DataFrame:
    """Forecasts of the fitted and of the reloaded models side by side."""
    rows = _stored(spark, sf, panel)
    fitted = pipeline.fit_all(rows, (), policies=LINEAR)
    folder = f"{_shared_folder(spark)}/models-{uuid.uuid4().hex}"
    loaded = {}
    for label, model in fitted.items():
        forecast.save_fitted(spark, model, f"{folder}/{label}")
        loaded[label] = forecast.load_fitted(spark, f"{folder}/{label}")
    before = pipeline.forecast_all(rows, "MS", 12, 2, fitted=fitted)
    after = pipeline.forecast_all(rows, "MS", 12, 2, fitted=loaded)
    both = before.join(after.withColumnRenamed("y_pred", "y_pred_loaded"), ["unique_id", "ds"])
    return _money(both, "y_pred", "y_pred_loaded")


def forecast_table(spark: SparkSession, sf: str) -> DataFrame:
    """From the stored training table to the stored forecasts of one version."""
    source = _store_prepared(spark, sf, panels.nation_segment)
    stored = pipeline.forecast_table(
        spark, source, f"forecast_{uuid.uuid4().hex}", "v1", "MS", 12, 3, (), policies=LINEAR
    )
    return _money(stored.drop("process_date"))


def forecast_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """All versions of a forecast table after a version was run twice, at first with a longer horizon."""
    source = _store_prepared(spark, sf, panels.part_month)
    output = f"forecast_{uuid.uuid4().hex}"
    for version, horizon in (("v1", 4), ("v2", 2), ("v1", 3)):
        pipeline.forecast_table(spark, source, output, version, "MS", 12, horizon, (), policies=LINEAR)
    return _money(spark.table(output).drop("process_date"))


WEEK = {7: 1}


def forecast_known_future(spark: SparkSession, sf: str) -> DataFrame:
    """From raw order lines to forecasts with a future column that the user brings: the sine of the week."""
    week, name = harmonics.harmonic_features("D", WEEK), harmonics.harmonic_names(WEEK)[0]
    training, future = (f"{kind}_{uuid.uuid4().hex}" for kind in ("training", "future"))
    lines = panels.table(spark, sf, "lineitem")
    rows = tables.standardise(lines, "l_suppkey", "l_shipdate", "l_quantity")
    buckets = max(cal.panel_size(rows, "D")[0], _buckets(spark))
    pipeline.build_training_table(
        spark, f"{sf}/lineitem.parquet", training, "l_suppkey", "l_shipdate", "l_quantity", "D", 7,
        INACTIVITY, MIN_RECORDS, [name], on_duplicate="sum", partition_by_label=True,
        buckets=buckets, features=[week],
    )
    pipeline.build_future_table(
        spark, training, future, "D", 7, 14, [name], features=[week], buckets=buckets
    )
    stored = pipeline.forecast_table(
        spark, training, f"forecast_{uuid.uuid4().hex}", "v1", "D", 7, 14, [name],
        policies=LINEAR, future=future,
    )
    return _money(stored.select("unique_id", "ds", "y_pred"))


def backtest_per_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Trend and seasonal recomputed from each fold's own history, and used by the model."""
    source = _store(training(spark, sf), decompose.FEATURES)
    rows = tables.read_training(spark, source, decompose.FEATURES)
    return pipeline.backtest_all(
        rows, 2, 3, policies=LINEAR, features="per_fold", season_length=12
    )


def load_for_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and dates of the training table and of the future that continues it."""
    table = f"training_{uuid.uuid4().hex}"
    tables.write_training(training(spark, sf), table, decompose.FEATURES)
    rows, future = pipeline.load_for_forecast(spark, table, decompose.FEATURES, 6, "MS", 12)
    return _bounds_and_counts(training=rows, future=future)


def _bounds_and_counts(**frames: DataFrame) -> DataFrame:
    parts = [
        frame.agg(
            F.min("ds").alias("min_ds"), F.max("ds").alias("max_ds"), F.count("*").alias("n_rows")
        ).select(F.lit(name).alias("dataset"), "min_ds", "max_ds", "n_rows")
        for name, frame in frames.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only for a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="demandpanel-models-")


# --- Stored tables ----------------------------------------------------------------


def training_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    table = f"training_{uuid.uuid4().hex}"
    rows = prepared(spark, sf).withColumn("level", F.avg("y").over(by_series()))
    tables.write_training(rows, table, ["level"])
    stored = tables.read_training(spark, table, ["level"])
    return _show(stored, "classification", _r("level"))


def forecast_append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    table = f"forecast_{uuid.uuid4().hex}"
    panel = panels.supplier_month(spark, sf)
    for version, factor in (("v1", 1.0), ("v2", 2.0)):
        rows = panel.select("unique_id", "ds", (F.col("y") * factor).alias("y_pred"))
        tables.append_forecasts(rows, version, table)
    return spark.table(table).select("unique_id", "ds", _r("y_pred"), "version")


def train_test_future_bounds(spark: SparkSession, sf: str) -> DataFrame:
    train, test, future = pipeline.train_test_future(
        spark, f"{sf}/lineitem.parquet", "l_suppkey", "l_shipdate", "l_quantity", SPLIT, 14, "D",
        7, INACTIVITY, MIN_RECORDS, on_duplicate="sum",
    )
    return _bounds_and_counts(train=train, test=test, future=future)


def build_training_table(spark: SparkSession, sf: str) -> DataFrame:
    """From raw order lines to the stored training table, one series per supplier and day."""
    stored = pipeline.build_training_table(
        spark, f"{sf}/lineitem.parquet", f"training_{uuid.uuid4().hex}", "l_suppkey",
        "l_shipdate", "l_quantity", "D", 7, INACTIVITY, MIN_RECORDS, on_duplicate="sum",
    )
    known = F.col("trend").isNotNull() & F.col("seasonal").isNotNull()
    return _show(stored, "classification", known.alias("decomposed"))



def clean_steps(spark: SparkSession, sf: str) -> DataFrame:
    df, sized = _laid_out(spark, sf, panels.part_returns_nullable, "MS")
    return _show(clean.clean(df, clean.standard_steps("MS", INACTIVITY, MIN_RECORDS, **sized)))


QUERIES: dict[str, Query] = {
    "read_series_panel": read_series_panel,
    "read_series_first": read_series_first,
    "read_series_permissive": read_series_permissive,
    "read_series_unreadable": read_series_unreadable,
    "split_train": _split(0),
    "split_test": _split(1),
    "dedupe_keys": dedupe_keys,
    "panel_bounds": panel_bounds,
    "fill_calendar_month_start": _on_filled(panels.nation_segment, "MS"),
    "fill_calendar_month_end": _on_filled(_month_ends(panels.part_month), "ME"),
    "fill_calendar_day": _on_filled(panels.user_day, "D"),
    "fill_calendar_week": _on_filled(panels.supplier_day, "W"),
    "fill_calendar_workday": _on_filled(panels.supplier_day, "B"),
    "fill_calendar_quarter": _on_filled(panels.nation_segment, "QS"),
    "fill_calendar_two_months": _on_filled(panels.nation_segment, "2MS"),
    "fill_calendar_business_month": _on_filled(panels.supplier_day, "BMS"),
    "fill_calendar_business_month_end": _on_filled(panels.supplier_day, "BME"),
    "fill_calendar_half_month": _on_filled(panels.supplier_day, "SMS"),
    "fill_calendar_static": _on_panel(
        panels.part_month_static,
        partial(_fill, freq="MS", static=["p_brand", "p_size"]),
        "p_brand",
        "p_size",
    ),
    "off_calendar_rows": _on_panel(panels.order_day, partial(cal.off_calendar_rows, freq="MS")),
    "trim_leading_nulls": _on_filled(panels.part_returns_nullable, "MS", clean.trim_leading_nulls),
    "trim_leading_zeros": _on_panel(panels.part_returns, clean.trim_leading_zeros),
    "drop_zero_only": _on_panel(panels.customer_refunds, clean.drop_zero_only),
    "drop_inactive": _on_panel(
        panels.part_returns, partial(clean.drop_inactive, periods=INACTIVITY)
    ),
    "drop_short": _on_panel(
        panels.customer_refunds, partial(clean.drop_short, min_records=MIN_RECORDS)
    ),
    "clean_all": lambda spark, sf: _show(cleaned(spark, sf, panels.customer_refunds)),
    "clean_steps": clean_steps,
    "cleaning_report": cleaning_report,
    "cleaning_report_observed": cleaning_report_observed,
    "demand_metrics": demand_metrics,
    "classify_demand": lambda spark, sf: _show(
        classify.classify_demand(cleaned(spark, sf, panels.nation_segment)), "classification"
    ),
    "class_distribution": class_distribution,
    "class_dispersion": class_dispersion,
    "impute_rolling_mean": _on_filled(
        panels.nation_segment, "MS", lambda df: impute.impute_rolling_mean(df, 3)
    ),
    "impute_rolling_median": _on_filled(
        panels.nation_segment, "MS", lambda df: impute.impute_rolling_median(df, 4)
    ),
    "impute_zero": _on_filled(panels.part_month, "MS", impute.impute_zero),
    "impute_by_class": lambda spark, sf: _show(
        impute.impute_by_class(
            classify.classify_demand(cleaned(spark, sf, panels.nation_segment))
        ),
        "classification",
    ),
    "prepare_panel": lambda spark, sf: _show(
        prepared(spark, sf, panels.part_month), "classification"
    ),
    "prepare_panel_day": lambda spark, sf: _show(
        prepared(spark, sf, panels.user_day, "D"), "classification"
    ),
    "future_calendar": future_calendar,
    "misaligned_series": misaligned_series,
    "series_function": series_function,
    "target_difference": target_difference,
    "target_local_scale": target_local_scale,
    "lag_features_smooth": _lag_features("Smooth"),
    "lag_features_erratic": _lag_features("Erratic"),
    "lag_features_lumpy": _lag_features("Lumpy"),
    "lag_features_intermittent": _lag_features("Intermittent"),
    "harmonic_features": harmonic_features,
    "mstl_train_features": mstl_train_features,
    "mstl_future_features": mstl_future_features,
    "future_features": future_features,
    "ensemble_mean": ensemble_mean,
    "cv_folds": cv_folds,
    "training_roundtrip": training_roundtrip,
    "forecast_append_roundtrip": forecast_append_roundtrip,
    "train_test_future_bounds": train_test_future_bounds,
    "layout_by_series": _on_panel(panels.part_month, pipeline.layout_by_series),
    "forecast_all": _forecast(panels.nation_segment, 6),
    "forecast_parts": _forecast(panels.part_month, 6),
    "forecast_parts_long": _forecast(panels.part_month, 60),
    "forecast_own_future": forecast_own_future,
    "forecast_known_future": forecast_known_future,
    "forecast_rerun": forecast_rerun,
    "backtest_all": _backtest(panels.nation_segment, 2, 3),
    "backtest_parts": _backtest(panels.part_month, 2, 3),
    "backtest_parts_folds": _backtest(panels.part_month, 6, 2),
    "importance_all": _importance(panels.nation_segment),
    "importance_parts": _importance(panels.part_month),
    "model_save_load": model_save_load,
    "model_save_load_parts": partial(model_save_load, panel=panels.part_month),
    "load_for_forecast": load_for_forecast,
    "build_training_table": build_training_table,
    "forecast_table": forecast_table,
    "backtest_per_fold": backtest_per_fold,
}
