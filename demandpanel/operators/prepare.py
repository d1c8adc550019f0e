"""Complete, clean, label and impute a panel in one go.

Everything up to the labels is decided on the observed rows, before the calendar is
filled: a filled period only adds a null, whose effect on each step follows from the
dates around it. Only the imputation then works on the longer, filled panel.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from demandpanel.functions.columns import LABEL, TARGET, TIME, by_series
from demandpanel.functions.frequency import Frequency, parse_frequency
from demandpanel.operators.calendar import Bounds, place_on_calendar, spread_over_calendar
from demandpanel.operators.classify import demand_aggregates, demand_label, demand_ratios
from demandpanel.operators.clean import first_date
from demandpanel.operators.impute import IMPUTATION_POLICY, Imputer, impute_by_class

#: Makes a label of the columns ADI and CV2 of a series.
Classifier = Callable[[Column, Column], Column]


def _trimmed(placed: DataFrame) -> DataFrame:
    """Both trims: a series starts at its first non-zero, else at its first known target."""
    begin = F.coalesce(first_date(F.col(TARGET) != 0), first_date(F.col(TARGET).isNotNull()))
    kept = F.col("_begin").isNull() | (F.col(TIME) >= F.col("_begin"))
    rows = placed.withColumn("_begin", begin).where(kept)
    # The periods before the first kept row are trimmed with it.
    at_begin = F.col(TIME) == F.col("_begin")
    start = F.when(at_begin, F.col("_at")).otherwise(F.col("_start"))
    first = F.coalesce(at_begin, F.col("_is_first"))
    return rows.withColumns({"_start": start, "_is_first": first}).drop("_begin")


class CleaningObservation:
    """Counts of series and rows before and after cleaning, gathered while the panel is written.

    Give one to ``prepare``; the frame it returns must be run once, by whatever writes it, and
    ``frame`` then has the columns of ``cleaning_report`` without reading anything again. Where that run
    computes a partition more than once (a lost executor, a frame that is read twice), Spark
    counts it once a completed run.
    """

    def __init__(self) -> None:
        self.before, self.after = Observation(), Observation()

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row: ``series_*`` and ``rows_*``, each ``before``, ``after`` and ``dropped``."""
        found = [o.get for o in (self.before, self.after)]
        row = {}
        for what in ("series", "rows"):
            was, now = (int(f[what] or 0) for f in found)
            row |= {f"{what}_before": was, f"{what}_after": now, f"{what}_dropped": was - now}
        return spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} long" for c in row))


def _observed(placed: DataFrame, observation: Observation | None, step: int) -> DataFrame:
    if observation is None:
        return placed
    covered: Column = (F.col("_stop") - F.col("_start")) / step + 1
    return placed.observe(
        observation,
        F.count_if("_is_first").alias("series"),
        F.sum(F.greatest(covered, F.lit(0)).cast("long")).alias("rows"),
    )


def labelled_panel(
    df: DataFrame,
    freq: str | Frequency,
    inactivity: int,
    min_records: int,
    static: Sequence[str] = (),
    bounds: Bounds = None,
    report: CleaningObservation | None = None,
    classify: Classifier | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """The same rows as filling, cleaning and classifying one after the other.

    ``classify`` makes the label of ADI and CV2; by default the four demand labels.
    """
    f = parse_frequency(freq)
    placed = place_on_calendar(df, f, static, bounds, partitions)
    rows = _trimmed(_observed(placed, report and report.before, f.step))
    # Where a run of zeros ends, counted from the back: at a gap, which the calendar
    # fills with nulls, or at a value that is not zero.
    covers = F.col("_start") <= F.col("_stop")
    gap = F.col("_at").isNull() | (F.col("_stop") > F.col("_at"))
    active = F.coalesce(F.col(TARGET) != 0, F.lit(True))
    run_end = F.when(covers & gap, F.col("_stop")).when(covers & active, F.col("_at"))
    stats = {
        "_top": F.max(TARGET),
        "_from": F.min("_start"),
        "_break": F.max(run_end),
        **demand_aggregates(),
    }
    rows = rows.withColumns({name: c.over(by_series()) for name, c in stats.items()})
    periods = (F.col("_grid.last") - F.col("_from")) / f.step + 1
    usable = F.col("_top").isNull() | (F.col("_top") != 0)
    if inactivity > 0:
        idle = F.coalesce((F.col("_grid.last") - F.col("_break")) / f.step, periods)
        usable &= idle < inactivity
    if min_records > 0:
        usable &= periods >= min_records
    adi, cv2 = demand_ratios(periods)
    kept = _observed(rows.where(usable), report and report.after, f.step)
    labelled = kept.withColumns({"_adi": adi, "_cv2": cv2})
    label = (classify or demand_label)(F.col("_adi"), F.col("_cv2"))
    labelled = labelled.withColumn(LABEL, label).drop(*stats, "_adi", "_cv2")
    # The label holds for the filled periods too, like a static column.
    filled = spread_over_calendar(labelled, f, [*static, LABEL])
    return filled.select(*[c for c in filled.columns if c != LABEL], LABEL)


def prepare(
    df: DataFrame,
    freq: str | Frequency,
    inactivity: int,
    min_records: int,
    static: Sequence[str] = (),
    policy: Mapping[str, Imputer] = IMPUTATION_POLICY,
    bounds: Bounds = None,
    report: CleaningObservation | None = None,
    classify: Classifier | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Complete, clean, label and impute a panel with unique keys, on one shuffle by series.

    Give a large panel the ``partitions`` of ``panel_size``: all the work on a series is in one task.
    """
    labelled = labelled_panel(
        df, freq, inactivity, min_records, static, bounds, report, classify, partitions
    )
    return impute_by_class(labelled, policy)
