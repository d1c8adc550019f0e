"""Trim and drop unusable series.

Each step is a filter on a window over one series, so a chain of steps needs a single
shuffle by series and no action. Keys must be unique (``read_series`` sees to that);
then a series never has more rows than the calendar has periods.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandpanel.functions.columns import ID, TARGET, TIME, by_series
from demandpanel.functions.frequency import Frequency
from demandpanel.operators.calendar import Bounds, fill_calendar

Step = Callable[[DataFrame], DataFrame]


def first_date(condition: Column) -> Column:
    """First date of the series where the condition holds."""
    return F.min(F.when(condition, F.col(TIME))).over(by_series())


def _trim(df: DataFrame, start: Column) -> DataFrame:
    kept = F.col("_start").isNull() | (F.col(TIME) >= F.col("_start"))
    return df.withColumn("_start", start).where(kept).drop("_start")


def trim_leading_nulls(df: DataFrame) -> DataFrame:
    """Drop rows before the first known target. A series of nulls stays."""
    return _trim(df, first_date(F.col(TARGET).isNotNull()))


def trim_leading_zeros(df: DataFrame) -> DataFrame:
    """Drop rows before the first non-zero target. A series of zeros stays."""
    return _trim(df, first_date(F.col(TARGET) != 0))


def drop_zero_only(df: DataFrame) -> DataFrame:
    """Drop series whose largest target is zero; a series of nulls stays."""
    return _drop(df, zero_only=True)


def drop_inactive(df: DataFrame, periods: int, nulls_inactive: bool = False) -> DataFrame:
    """Drop series ending in at least ``periods`` zeros; ``periods <= 0`` keeps all.

    A null is not a zero and ends the run, unless ``nulls_inactive`` is set.
    """
    return _drop(df, inactivity=periods, nulls_inactive=nulls_inactive)


def drop_short(df: DataFrame, min_records: int) -> DataFrame:
    """Drop series with fewer than ``min_records`` rows, nulls counted; ``<= 0`` keeps all."""
    return _drop(df, min_records=min_records)


def _drop(
    df: DataFrame,
    zero_only: bool = False,
    inactivity: int = 0,
    min_records: int = 0,
    nulls_inactive: bool = False,
) -> DataFrame:
    """Keep the series that pass every requested test, all tests in one pass."""
    columns = df.columns
    tests = []
    out = df
    if zero_only:
        out = out.withColumn("_top", F.max(TARGET).over(by_series()))
        tests.append(F.col("_top").isNull() | (F.col("_top") != 0))
    if min_records > 0:
        out = out.withColumn("_rows", F.count(F.lit(1)).over(by_series()))
        tests.append(F.col("_rows") >= min_records)
    if inactivity > 0:
        active = F.coalesce(F.col(TARGET) != 0, F.lit(not nulls_inactive))
        last_active = F.max(F.when(active, F.col(TIME))).over(by_series())
        idle = F.col("_active").isNull() | (F.col(TIME) > F.col("_active"))
        out = out.withColumn("_active", last_active).withColumn(
            "_idle", F.count(F.when(idle, F.lit(1))).over(by_series())
        )
        tests.append(F.col("_idle") < inactivity)
    if not tests:
        return df
    return out.where(reduce(lambda a, b: a & b, tests)).select(*columns)


def clean_series(
    df: DataFrame, inactivity: int, min_records: int, nulls_inactive: bool = False
) -> DataFrame:
    """Both trims and the three drops, fused: same rows as the steps one by one.

    Where a non-zero target exists the zero trim covers the null trim, so one window
    finds the start of the series.
    """
    start = F.coalesce(first_date(F.col(TARGET) != 0), first_date(F.col(TARGET).isNotNull()))
    return _drop(_trim(df, start), True, inactivity, min_records, nulls_inactive)


def clean(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Apply cleaning steps, each a function from DataFrame to DataFrame, in order."""
    if not steps:
        warnings.warn("clean() got no steps; the panel is returned unchanged", stacklevel=2)
        return df
    for step in steps:
        if not callable(step):
            raise TypeError(f"A cleaning step must be callable, got {type(step).__name__}")
    return reduce(lambda frame, step: frame.transform(step), steps, df)


def standard_steps(
    freq: str | Frequency,
    inactivity: int,
    min_records: int,
    static: Sequence[str] = (),
    bounds: Bounds = None,
    partitions: int | None = None,
) -> list[Step]:
    """The standard order: calendar, null trim, zero trim, zero-only, inactive, short."""
    return [
        partial(fill_calendar, freq=freq, static=static, bounds=bounds, partitions=partitions),
        trim_leading_nulls,
        trim_leading_zeros,
        drop_zero_only,
        partial(drop_inactive, periods=inactivity),
        partial(drop_short, min_records=min_records),
    ]


def cleaning_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: series and rows before, after and dropped."""
    counts = (
        before.select(ID, F.lit(1).alias("was"), F.lit(0).alias("is"))
        .unionByName(after.select(ID, F.lit(0).alias("was"), F.lit(1).alias("is")))
        .groupBy(ID)
        .agg(F.sum("was").alias("was"), F.sum("is").alias("is"))
    )
    totals = counts.agg(
        F.count_if(F.col("was") > 0).alias("series_before"),
        F.count_if(F.col("is") > 0).alias("series_after"),
        F.coalesce(F.sum("was"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("is"), F.lit(0)).alias("rows_after"),
    )
    return totals.select(
        "*",
        (F.col("series_before") - F.col("series_after")).alias("series_dropped"),
        (F.col("rows_before") - F.col("rows_after")).alias("rows_dropped"),
    )
