"""Fill gaps in the target: rolling statistic, then last known value, then a constant.

Imputers are column expressions, so a policy for all labels is one conditional column
over one sorted window instead of a branch and union per label.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.functions.columns import ID, LABEL, LABELS, TARGET, TIME, in_time, require_columns

Imputer = Callable[[], Column]


def _check_window(size: int) -> None:
    if size < 1:
        raise ValueError("window size must be >= 1")


def _fill(rolling: Column, fallback: float) -> Column:
    known = in_time().rowsBetween(Window.unboundedPreceding, 0)
    last_known = F.last(TARGET, ignorenulls=True).over(known)
    return F.coalesce(F.col(TARGET), rolling, last_known, F.lit(float(fallback)))


def rolling_mean(size: int, fallback: float = 0.0) -> Column:
    """Mean of the known targets among the last ``size`` rows."""
    _check_window(size)
    return _fill(F.avg(TARGET).over(in_time().rowsBetween(-(size - 1), 0)), fallback)


def rolling_median(size: int = 6, fallback: float = 0.0) -> Column:
    """Lower median of the known targets among the last ``size`` rows.

    The known values of the frame are sorted only where the target is missing.
    """
    _check_window(size)
    frame = in_time().rowsBetween(-(size - 1), 0)
    known = F.collect_list(TARGET).over(frame)
    middle = F.floor((F.count(TARGET).over(frame) - 1) / 2).cast("int")
    return _fill(F.get(F.sort_array(known), middle), fallback)


def zero() -> Column:
    return F.coalesce(F.col(TARGET), F.lit(0.0))


# Imputer and window per label.
IMPUTATION_POLICY: dict[str, Imputer] = {
    "Smooth": partial(rolling_mean, 3),
    "Erratic": partial(rolling_median, 4),
    "Intermittent": zero,
    "Lumpy": partial(rolling_median, 12),
}


def impute_rolling_mean(df: DataFrame, size: int, fallback: float = 0.0) -> DataFrame:
    return df.withColumn(TARGET, rolling_mean(size, fallback))


def impute_rolling_median(df: DataFrame, size: int = 6, fallback: float = 0.0) -> DataFrame:
    return df.withColumn(TARGET, rolling_median(size, fallback))


def impute_zero(df: DataFrame) -> DataFrame:
    return df.withColumn(TARGET, zero())


def impute_by_class(
    df: DataFrame, policy: Mapping[str, Imputer] = IMPUTATION_POLICY
) -> DataFrame:
    """Impute each label by its policy; rows without a known label are left out."""
    require_columns(df, [ID, TIME, TARGET, LABEL])
    missing = [label for label in LABELS if label not in policy]
    if missing:
        raise ValueError(f"No imputer for labels: {missing}")
    choice = F.lit(None).cast("double")
    for label in LABELS:
        choice = F.when(F.col(LABEL) == label, policy[label]()).otherwise(choice)
    return df.where(F.col(LABEL).isin(*LABELS)).withColumn(TARGET, choice)
