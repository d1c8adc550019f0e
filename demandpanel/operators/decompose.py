"""Trend and seasonal features per series."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandpanel.functions import smoothing
from demandpanel.functions.columns import ID, TARGET, TIME, require_columns
from demandpanel.functions.frequency import Frequency, parse_frequency
from demandpanel.operators.calendar import date_bounds, future_indices, next_index

# Ship the numeric helper with the task instead of asking executors to import it.
cloudpickle.register_pickle_by_value(smoothing)

FEATURES = ("trend", "seasonal")


def apply_per_series(
    df: DataFrame,
    function: Callable[[tuple, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Run ``function(key, rows)`` on each series, rows sorted by date.

    Keys must be unique, so that a group is no longer than the calendar.
    """

    def ordered(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return function(key, rows.sort_values("ds", kind="stable"))

    return df.groupBy(ID).applyInPandas(ordered, schema)


def series_rows(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per series: ``rows``, an array of (ds, columns) sorted by date.

    ``keep`` columns are constant in a series and stay beside the array. The array is
    as long as the series, hence bounded by the calendar; where the frame is already
    partitioned by series this adds no shuffle.
    """
    entry = F.struct(TIME, *columns)
    return df.groupBy(ID, *keep).agg(F.sort_array(F.collect_list(entry)).alias("rows"))


def explode_rows(rows: Column) -> Column:
    """Explode an array that is never empty.

    For a plain explode the optimizer infers a filter on the array's size and evaluates
    whatever computes the array, Python included, once more for it.
    """
    return F.explode_outer(rows)


def _components_udf(season_length: int, horizon: int):
    @F.pandas_udf("trend array<double>, seasonal array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # The parts of a batch are handed back as they are made: an Arrow batch is cut by its number of
        # series, however long these are.
        for batch in batches:
            for some in smoothing.in_parts(batch):
                series = [smoothing.without_gaps(np.asarray(v, dtype=float)) for v in some]
                trend, seasonal = smoothing.components(series, season_length, horizon)
                yield pd.DataFrame({"trend": trend, "seasonal": seasonal})

    return run


def components(values: Column, season_length: int, horizon: int = 0) -> Column:
    """Struct of arrays ``trend, seasonal`` of an array of targets, ``horizon`` periods longer.

    A missing target counts as the last known one, a leading one as zero.
    """
    return _components_udf(season_length, horizon)(values)


def mstl_features(df: DataFrame, season_length: int) -> DataFrame:
    """Add ``trend`` and ``seasonal`` to every row of a panel.

    The other columns travel with the series, so nothing is joined back.
    """
    require_columns(df, [ID, TIME, TARGET])
    others = [c for c in df.columns if c not in (ID, TIME, *FEATURES)]
    targets = F.transform("rows", lambda r: r[TARGET])
    parts = series_rows(df, others).select(
        ID, "rows", components(targets, season_length).alias("parts")
    )
    zipped = F.arrays_zip("rows", F.col("parts.trend"), F.col("parts.seasonal"))
    out = parts.select(ID, explode_rows(zipped).alias("r"))
    columns = [c for c in df.columns if c not in (ID, *FEATURES)]
    return out.select(
        ID, *[F.col(f"r.rows.{c}").alias(c) for c in columns], *[f"r.{c}" for c in FEATURES]
    )


def with_ahead(
    series: DataFrame,
    season_length: int,
    horizon: int,
    freq: str | Frequency,
    last: DataFrame,
) -> DataFrame:
    """Add ``ahead`` to one-row-per-series ``rows``: the next periods with their features.

    ``last`` holds the global last date (``hi``) after which the periods start. Features
    count from the end of each series; where a series ends early, periods past its own
    horizon get null.
    """
    f = parse_frequency(freq)
    if horizon <= 0:
        raise ValueError("horizon must be > 0")
    targets = F.transform("rows", lambda r: r[TARGET])
    parts = series.select(
        "*",
        f.floor(F.element_at("rows", -1)[TIME]).alias("_own"),
        components(targets, season_length, horizon).alias("_parts"),
    ).withColumn("_next", last.select(next_index(f, F.col("hi"))).scalar())

    def period(k: Column) -> Column:
        distance = k - F.col("_own")
        place = (F.size("rows") + distance / f.step - 1).cast("int")
        known = F.pmod(distance, F.lit(f.step)) == 0
        values = [F.when(known, F.get(F.col(f"_parts.{c}"), place)).alias(c) for c in FEATURES]
        return F.struct(f.date_of(k).alias(TIME), *values)

    steps = future_indices(f, F.col("_next"), horizon)
    return parts.withColumn("ahead", F.transform(steps, period)).drop("_own", "_parts", "_next")


def mstl_future(
    df: DataFrame,
    season_length: int,
    horizon: int,
    freq: str | Frequency,
    last: DataFrame | None = None,
) -> DataFrame:
    """``unique_id, ds, trend, seasonal`` for the periods after the global last date.

    ``misaligned_series`` lists series that end early and so have fewer features.
    """
    require_columns(df, [ID, TIME, TARGET])
    last = date_bounds(df) if last is None else last
    ahead = with_ahead(series_rows(df, [TARGET]), season_length, horizon, freq, last)
    return ahead.select(ID, explode_rows(F.col("ahead")).alias("r")).select(ID, "r.*")


def misaligned_series(df: DataFrame) -> DataFrame:
    """Series that end before the global last date."""
    end = df.agg(F.max(TIME)).scalar()
    ends = df.groupBy(ID).agg(F.max(TIME).alias("last_ds"))
    return ends.select(ID, "last_ds", end.alias("global_last_ds")).where(
        F.col("last_ds") < F.col("global_last_ds")
    )


def add_features(
    df: DataFrame, features: Sequence[Callable[[DataFrame], DataFrame]]
) -> DataFrame:
    """Apply exogenous-feature functions in order."""
    for feature in features:
        df = df.transform(feature)
    return df
