"""Label every series by demand pattern: interval between demands and their variation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandpanel.functions.columns import ID, LABEL, TARGET, by_series

# Thresholds of average demand interval and squared variation.
ADI_THRESHOLD = 1.32
CV2_THRESHOLD = 0.49


def demand_aggregates() -> dict[str, Column]:
    """Demand statistics of a series; only ``y > 0`` counts as demand."""
    demand = F.when(F.col(TARGET) > 0, F.col(TARGET))
    return {
        "_demands": F.count(demand),
        "_mean": F.avg(demand),
        "_std": F.stddev_pop(demand),
    }


def demand_ratios(periods: Column) -> tuple[Column, Column]:
    """Average demand interval and squared variation; infinite where undefined."""
    infinity = F.lit(float("inf"))
    adi = F.when(F.col("_demands") > 0, periods / F.col("_demands"))
    cv2 = F.when(F.col("_mean") > 0, F.pow(F.col("_std") / F.col("_mean"), F.lit(2.0)))
    return F.coalesce(adi, infinity), F.coalesce(cv2, infinity)


def demand_label(adi: Column, cv2: Column) -> Column:
    frequent, steady = adi < ADI_THRESHOLD, cv2 < CV2_THRESHOLD
    return (
        F.when(frequent & steady, "Smooth")
        .when(steady, "Intermittent")
        .when(frequent, "Erratic")
        .otherwise("Lumpy")
    )


def demand_metrics(df: DataFrame) -> DataFrame:
    """``unique_id, classification, adi, cv2``, one row per series."""
    stats = df.groupBy(ID).agg(
        F.count(F.lit(1)).alias("_periods"),
        *[c.alias(name) for name, c in demand_aggregates().items()],
    )
    adi, cv2 = demand_ratios(F.col("_periods"))
    return stats.select(ID, adi.alias("adi"), cv2.alias("cv2")).select(
        ID, demand_label(F.col("adi"), F.col("cv2")).alias(LABEL), "adi", "cv2"
    )


def classify_demand(df: DataFrame) -> DataFrame:
    """Add ``classification`` to every row, over the shuffle by series already in the plan."""
    stats = df.select(
        "*",
        F.count(F.lit(1)).over(by_series()).alias("_periods"),
        *[c.over(by_series()).alias(name) for name, c in demand_aggregates().items()],
    )
    adi, cv2 = demand_ratios(F.col("_periods"))
    return stats.select(*df.columns, adi.alias("_adi"), cv2.alias("_cv2")).select(
        *df.columns, demand_label(F.col("_adi"), F.col("_cv2")).alias(LABEL)
    )


def class_distribution(metrics: DataFrame) -> DataFrame:
    """Number of series per label, in the order of labels."""
    return metrics.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n_series")).orderBy(LABEL)


def class_dispersion(metrics: DataFrame) -> DataFrame:
    """Spread of both metrics inside each label, in the order of labels."""
    aggregates = [F.count(F.lit(1)).alias("n_series")]
    for name in ("adi", "cv2"):
        aggregates += [
            F.avg(name).alias(f"mean_{name}"),
            F.stddev_pop(name).alias(f"std_intra_{name}"),
            F.var_pop(name).alias(f"var_intra_{name}"),
            F.percentile_approx(name, [0.5, 0.9], 1000).alias(f"_{name}"),
        ]
    spread = metrics.groupBy(LABEL).agg(*aggregates)
    columns = [LABEL, "n_series"]
    for name in ("adi", "cv2"):
        columns += [f"mean_{name}", f"std_intra_{name}", f"var_intra_{name}"]
        columns += [
            F.col(f"_{name}")[0].alias(f"{name}_p50"),
            F.col(f"_{name}")[1].alias(f"{name}_p90"),
        ]
    return spread.select(*columns).orderBy(LABEL)
