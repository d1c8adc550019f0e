"""Target transforms and lag features for training, as windows over one series."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandpanel.functions.columns import ID, TARGET, TIME, require_columns
from demandpanel.functions.spec import (
    DIFFERENCE, SCALE, ExpandingStd, ExponentialMean, ModelSpec, RollingMean,
)

TRANSFORMED = "z"
#: What tells series apart; a frame of several folds has the fold, too.
SERIES = (ID,)


def difference(
    df: DataFrame, column: str = TARGET, into: str = TRANSFORMED, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Change since the previous row; null on the first row."""
    earlier = F.lag(column).over(Window.partitionBy(*keys).orderBy(TIME))
    return df.withColumn(into, F.col(column) - earlier)


def local_scale(
    df: DataFrame, column: str = TARGET, into: str = TRANSFORMED, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Centre and scale by the mean and population deviation of the series."""
    whole = Window.partitionBy(*keys)
    mean, std = F.avg(column).over(whole), F.stddev_pop(column).over(whole)
    scaled = df.withColumn("_mean", mean).withColumn("_std", std)
    return scaled.withColumn(
        into, (F.col(column) - F.col("_mean")) / scale_of(F.col("_std"))
    ).drop("_mean", "_std")


def scale_of(std: Column) -> Column:
    """A constant series is centred only."""
    return F.when(std > 0, std).otherwise(1.0)


def transform_target(df: DataFrame, spec: ModelSpec, keys: Sequence[str] = SERIES) -> DataFrame:
    """Add ``z``: the target after the spec's transforms, in their order."""
    steps = {DIFFERENCE: difference, SCALE: local_scale}
    df = df.withColumn(TRANSFORMED, F.col(TARGET))
    for name in spec.target_transforms:
        df = steps[name](df, TRANSFORMED, keys=keys)
    return df


def ewm_terms(alpha: float) -> int:
    """Terms after which the oldest weight is below double precision."""
    return math.ceil(math.log(1e-16) / math.log(1 - alpha)) + 1


def running_ewm(
    df: DataFrame, alpha: float, into: str, column: str = TRANSFORMED, keys: Sequence[str] = SERIES
) -> tuple[DataFrame, str]:
    """Add the exponentially weighted mean of the series up to each row.

    The recursion becomes running sums of values weighted by ``(1 - alpha)`` to minus
    their place, restarted in blocks so that the weights stay within double range; the
    mean at the end of the previous block carries the rest. Each row costs the same
    however long the series. Also returns the block column: ordering by it and the date
    is ordering by date, and windows that do so share this function's sort.
    """
    terms, keep = ewm_terms(alpha), F.lit(1 - alpha)
    block, place, own = f"_block_{into}", f"_place_{into}", f"_own_{into}"
    in_time = Window.partitionBy(*keys).orderBy(TIME)
    known_before = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn(place, F.count(column).over(known_before) - 1).withColumns(
        {block: F.floor(F.col(place) / terms), place: F.pmod(F.col(place), F.lit(terms))}
    )
    is_first = (F.col(place) == 0) & (F.col(block) == 0)
    weight = F.when(is_first, 1.0).otherwise(alpha) * F.pow(keep, -F.col(place))
    in_block = Window.partitionBy(*keys, block).orderBy(TIME)
    total = F.sum(F.col(column) * weight).over(
        in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumn(own, total * F.pow(keep, F.col(place)))
    earlier = Window.partitionBy(*keys).orderBy(block, TIME).rowsBetween(
        Window.unboundedPreceding, -1
    )
    at_block_end = F.when(F.col(place) == terms - 1, F.col(own))
    carried = F.last(at_block_end, ignorenulls=True).over(earlier)
    rows = rows.withColumn("_carried", carried)
    rest = F.when(F.col(block) > 0, F.pow(keep, F.col(place) + 1) * F.col("_carried"))
    rows = rows.withColumn(into, F.col(own) + F.coalesce(rest, F.lit(0.0)))
    return rows.drop(place, own, "_carried"), block


def lag_features(
    df: DataFrame,
    spec: ModelSpec,
    exogenous: Sequence[str] = (),
    static: Sequence[str] = (),
    keep_incomplete: bool = False,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """The model matrix: key, ``y``, ``z``, static and exogenous columns, lag features.

    All windows share the shuffle by series. Rows with a missing target or lag feature
    are left out unless ``keep_incomplete``. ``keys`` tell the series apart.
    """
    require_columns(df, [*keys, TIME, TARGET, *static, *exogenous])
    out = transform_target(df.select(*keys, TIME, TARGET, *static, *exogenous), spec, keys)
    blocks = []
    for name, (_, t) in spec.lag_features().items():
        if isinstance(t, ExponentialMean):
            out, block = running_ewm(out, t.alpha, f"_now_{name}", keys=keys)
            blocks = [block]
    series = Window.partitionBy(*keys).orderBy(*blocks, TIME)
    windowed, final = [], []
    for name, (lag, t) in spec.lag_features().items():
        if t is None:
            windowed.append(F.lag(TRANSFORMED, lag).over(series).alias(name))
            final.append(F.col(name))
        elif isinstance(t, RollingMean):
            recent = series.rowsBetween(-(lag + t.size - 1), -lag)
            windowed.append(F.avg(TRANSFORMED).over(recent).alias(f"_mean_{name}"))
            windowed.append(F.count(TRANSFORMED).over(recent).alias(f"_count_{name}"))
            enough = F.col(f"_count_{name}") >= t.needed
            final.append(F.when(enough, F.col(f"_mean_{name}")).alias(name))
        elif isinstance(t, ExpandingStd):
            up_to_lag = series.rowsBetween(Window.unboundedPreceding, -lag)
            windowed.append(F.stddev_samp(TRANSFORMED).over(up_to_lag).alias(name))
            final.append(F.col(name))
        elif isinstance(t, ExponentialMean):
            windowed.append(F.lag(f"_now_{name}", lag).over(series).alias(name))
            final.append(F.col(name))
    columns = [*keys, TIME, TARGET, TRANSFORMED, *static, *exogenous]
    out = out.select(*columns, *windowed).select(*columns, *final)
    if keep_incomplete:
        return out
    return out.dropna(subset=[TRANSFORMED, *spec.lag_features()])
