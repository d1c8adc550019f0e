"""Complete calendars and future periods."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandpanel.functions.columns import ID, TARGET, TIME, in_time, require_columns
from demandpanel.functions.frequency import Frequency, parse_frequency

Bounds = DataFrame | tuple[datetime.date | str, datetime.date | str] | None

#: Rows of the filled panel that one partition by series is to hold.
TASK_ROWS = 1 << 18


def date_bounds(df: DataFrame) -> DataFrame:
    """One row ``lo, hi``: the first and last date of the frame."""
    return df.agg(F.min(TIME).alias("lo"), F.max(TIME).alias("hi"))


def panel_size(df: DataFrame, freq: str | Frequency) -> tuple[int, Bounds]:
    """Partitions by series that hold ``TASK_ROWS`` rows of the filled panel each, and its bounds.

    Runs a job of one aggregate, on rows whose keys may repeat. The session's shuffles have as many
    partitions at any size, and adaptive execution merges them by what is shuffled, which is the panel
    before it is filled: given as ``partitions``, this number keeps the memory of a task from growing.
    """
    f = parse_frequency(freq)
    first = f.ceil(F.col("lo"))
    periods = (f.snap_down(f.floor(F.col("hi")), first) - first) / f.step + 1
    found = df.agg(
        F.approx_count_distinct(ID).alias("series"), F.min(TIME).alias("lo"), F.max(TIME).alias("hi")
    ).withColumn("rows", F.col("series") * F.greatest(periods, F.lit(1)))
    size = found.select("lo", "hi", F.ceil(F.col("rows") / TASK_ROWS).alias("n")).first()
    if size["lo"] is None:
        return 1, None
    return max(1, int(size["n"])), (size["lo"], size["hi"])


def calendar_end(bounds: DataFrame, freq: str | Frequency) -> DataFrame:
    """One row ``hi``: the last period between two dates, where every filled series ends."""
    f = parse_frequency(freq)
    last = f.snap_down(f.floor(F.col("hi")), f.ceil(F.col("lo")))
    return bounds.select(f.date_of(last).alias("hi"))


def _day(value: datetime.date | str) -> Column:
    return F.lit(str(value)[:10]).cast("date")


def _grid(df: DataFrame, f: Frequency, bounds: Bounds) -> Column:
    """First and last calendar index, as a literal struct or one scalar subquery."""

    def ends(lo: Column, hi: Column) -> Column:
        first = f.ceil(lo)
        return F.struct(first.alias("first"), f.snap_down(f.floor(hi), first).alias("last"))

    if isinstance(bounds, tuple):
        return ends(_day(bounds[0]), _day(bounds[1]))
    frame = date_bounds(df) if bounds is None else bounds
    return frame.select(ends(F.col("lo"), F.col("hi"))).scalar()


def _indices(first: Column, last: Column, step: int) -> Column:
    """Grid indices from ``first`` to ``last``; empty when there are none."""
    nothing = F.array().cast("array<int>")
    return F.when(first <= last, F.sequence(first, last, F.lit(step))).otherwise(nothing)


def calendar(
    spark: SparkSession, freq: str | Frequency, lo: datetime.date | str, hi: datetime.date | str
) -> DataFrame:
    """The anchors of ``freq`` between two dates, one row per period."""
    f = parse_frequency(freq)
    ends = spark.range(1).select(f.ceil(_day(lo)).alias("first"), f.floor(_day(hi)).alias("last"))
    index = F.explode(_indices(F.col("first"), F.col("last"), f.step))
    return ends.select(index.alias("k")).select(f.date_of(F.col("k")).alias(TIME))


def place_on_calendar(
    df: DataFrame,
    freq: str | Frequency,
    static: Sequence[str] = (),
    bounds: Bounds = None,
    partitions: int | None = None,
) -> DataFrame:
    """Each row with the calendar periods it covers: index ``_start`` to ``_stop``.

    Rows, ordered by date inside their series, cover the periods from their own date up
    to the next row's date; the first also those since the global start, the last those
    up to the global end. ``_at`` is the row's own index, null off the calendar, where
    the values are lost too. ``_grid`` holds the first and last index of the calendar,
    ``_is_first`` marks a row of each series. The rows are dealt to ``partitions`` by series
    (``panel_size``), else to as many as the session shuffles to.
    """
    f = parse_frequency(freq)
    static = list(static)
    require_columns(df, [ID, TIME, TARGET, *static])
    carried = [c for c in df.columns if c not in (ID, TIME, *static)]
    whole = in_time().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dated = df.where(F.col(TIME).isNotNull())
    rows = (
        (dated.repartition(partitions, ID) if partitions else dated)
        .withColumn("_at", f.ceil(F.col(TIME)))
        .select(
            ID, TIME, "_at", *carried,
            *[F.last(c).over(whole).alias(c) for c in static],
            F.lag(TIME).over(in_time()).isNull().alias("_is_first"),
            F.lead("_at").over(in_time()).alias("_next"),
        )
        # Outside the windows, so that the bounds are not shuffled with every row.
        .withColumn("_grid", _grid(df, f, bounds))
    )
    first, last = F.col("_grid.first"), F.col("_grid.last")
    start = F.greatest(f.snap(F.col("_at"), first), first)
    stop = F.least(f.snap(F.col("_next"), first) - f.step, last)
    own = f.on_grid(F.col(TIME), first) & F.col("_at").between(first, last)
    placed = rows.withColumns(
        {
            "_start": F.when(F.col("_is_first"), first).otherwise(start),
            # A row on the calendar always covers its own period, repeats included.
            "_stop": F.when(own, F.greatest(stop, F.col("_at"))).otherwise(stop),
            "_own": own,
        }
    )
    on_calendar = {c: F.when(F.col("_own"), F.col(c)) for c in ["_at", *carried]}
    return placed.withColumns(on_calendar).drop("_next", "_own")


def spread_over_calendar(
    placed: DataFrame, freq: str | Frequency, static: Sequence[str] = ()
) -> DataFrame:
    """One row per covered period, the values on the row's own period only."""
    f = parse_frequency(freq)
    hidden = ("_at", "_start", "_stop", "_grid", "_is_first")
    carried = [c for c in placed.columns if c not in (ID, TIME, *static, *hidden)]
    covered = _indices(F.col("_start"), F.col("_stop"), f.step)
    periods = placed.select(ID, "_at", *static, *carried, F.explode(covered).alias("_k"))
    return periods.select(
        ID,
        f.date_of(F.col("_k")).alias(TIME),
        *static,
        *[F.when(F.col("_k") == F.col("_at"), F.col(c)).alias(c) for c in carried],
    )


def fill_calendar(
    df: DataFrame,
    freq: str | Frequency,
    static: Sequence[str] = (),
    bounds: Bounds = None,
    partitions: int | None = None,
) -> DataFrame:
    """Give every series one row per calendar period between the global bounds.

    One shuffle by series does the work of the id-by-calendar product and the join back,
    and later steps keep that partitioning. Rows off the calendar are lost
    (``off_calendar_rows`` lists them) but still hold their series in the panel. Static
    columns get the value of the last date.

    ``bounds`` may be a ``(lo, hi)`` frame or pair; by default it is read from ``df``.
    Rows outside them are off the calendar. Give a large panel the ``partitions`` of ``panel_size``.
    """
    placed = place_on_calendar(df, freq, static, bounds, partitions)
    return spread_over_calendar(placed, freq, static)


def off_calendar_rows(df: DataFrame, freq: str | Frequency, bounds: Bounds = None) -> DataFrame:
    """Rows that ``fill_calendar`` loses because their date is not on the calendar."""
    f = parse_frequency(freq)
    grid = F.col("_grid")
    kept = f.on_grid(F.col(TIME), grid["first"]) & f.ceil(F.col(TIME)).between(
        grid["first"], grid["last"]
    )
    return df.withColumn("_grid", _grid(df, f, bounds)).where(~kept).drop("_grid")


def future_calendar(
    df: DataFrame, horizon: int, freq: str | Frequency, last: DataFrame | None = None
) -> DataFrame:
    """The ``horizon`` periods after the global last date, for every series."""
    f = parse_frequency(freq)
    if horizon <= 0:
        raise ValueError("horizon must be > 0")
    ids = df.select(ID).distinct()
    frame = date_bounds(df) if last is None else last
    future = ids.withColumn("_next", frame.select(next_index(f, F.col("hi"))).scalar())
    return future.select(
        ID, F.explode(future_indices(f, F.col("_next"), horizon)).alias("_k")
    ).select(ID, f.date_of(F.col("_k")).alias(TIME))


def next_index(f: Frequency, last: Column) -> Column:
    """The period after ``last``: a whole multiple on from an anchor, else the next anchor."""
    at = f.floor(last)
    return at + F.when(f.date_of(at) == last, F.lit(f.step)).otherwise(F.lit(f.base))


def future_indices(f: Frequency, first: Column, horizon: int) -> Column:
    return F.sequence(first, first + (horizon - 1) * f.step, F.lit(f.step))
