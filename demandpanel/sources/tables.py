"""Read and write panels: raw series, training table, forecast table."""

from __future__ import annotations

import datetime
import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from demandpanel.functions.columns import (
    ID, LABEL, TARGET, TIME, require_columns, require_text,
)

#: Parts of a key's rows that are merged apart before they meet, where a panel is dealt by its size.
SLICES = 8


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A catalog table by name, or parquet files where the source is a path."""
    require_text("source", source)
    if os.sep in source:
        return spark.read.parquet(source)
    return spark.table(source)


def _day(value: datetime.date | str) -> Column:
    return F.lit(str(value)[:10]).cast("date")


def standardise(
    df: DataFrame,
    id_column: str,
    time_column: str,
    target_column: str,
    static: Sequence[str] | None = None,
    mode: str = "strict",
    after: datetime.date | str | None = None,
    until: datetime.date | str | None = None,
) -> DataFrame:
    """Project raw rows to ``unique_id, ds, y`` and static columns.

    ``after`` (exclusive) and ``until`` (inclusive) are dates; on date and timestamp
    columns they become filters on the raw column, which reach the file scan.
    ``strict`` raises on keys that are null or cannot be read; ``permissive`` turns
    unreadable values to null and leaves rows without a key out. NaN counts as null.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError("mode must be 'strict' or 'permissive'")
    static = list(static or [])
    require_columns(df, [id_column, time_column, target_column, *static])
    raw_time = F.col(time_column)
    kind = dict(df.dtypes)[time_column]
    dated = kind == "date" or kind.startswith("timestamp")
    permissive = mode == "permissive"
    day = raw_time.try_cast("date") if permissive else F.to_date(raw_time)
    number = F.col(target_column)
    number = number.try_cast("double") if permissive else number.cast("double")

    kept = df
    if dated:
        # Bounds on the stored type: a date compared with itself, a time with midnight.
        if after is not None:
            kept = kept.where(raw_time >= F.date_add(_day(after), 1).cast(kind))
        if until is not None:
            kept = kept.where(raw_time < F.date_add(_day(until), 1).cast(kind))
    rows = kept.select(
        F.col(id_column).cast("string").alias(ID),
        day.alias(TIME),
        F.when(~F.isnan(number), number).alias(TARGET),
        *static,
    )
    if not dated and after is not None:
        rows = rows.where(F.col(TIME) > _day(after))
    if not dated and until is not None:
        rows = rows.where(F.col(TIME) <= _day(until))
    keyed = F.col(ID).isNotNull() & F.col(TIME).isNotNull()
    if permissive:
        return rows.where(keyed)
    problem = F.raise_error(F.lit("Null or unreadable series id or date")).cast("boolean")
    return rows.where(F.when(keyed, F.lit(True)).otherwise(problem))


def merge_keys(
    df: DataFrame, how: Mapping[str, Callable[[str], Column]], partitions: int | None = None
) -> DataFrame:
    """One row per (unique_id, ds), each column of ``how`` merged by its function.

    The functions must merge what they have merged (sum, min, max). Rows are merged in as many partitions
    as the session shuffles to, unless the panel needs more ``partitions`` (``panel_size``): then they
    are dealt to so many, first by the whole key and, so that no key holds up a task, by
    ``SLICES`` of the partitions they come from, then by series, where they stay.
    """

    def merged(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(*[merge(c).alias(c) for c, merge in how.items()])

    if not partitions or partitions <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return merged(df, ID, TIME)
    keys = (ID, TIME, "_slice")
    sliced = df.withColumn("_slice", F.spark_partition_id() % SLICES)
    parts = merged(sliced.repartition(partitions, *keys), *keys)
    return merged(parts.repartition(partitions, ID), ID, TIME)


def unique_keys(
    df: DataFrame, on_duplicate: str = "error", partitions: int | None = None
) -> DataFrame:
    """One row per (unique_id, ds): ``error`` on repeats, ``sum`` targets, or keep the ``first``.

    Grouping by the whole key with partial sums keeps a series that holds most raw rows
    from landing in one task. ``first`` takes the smallest known target, so that the
    result does not depend on file order. Give a large panel the ``partitions`` of ``panel_size``.
    """
    require_columns(df, [ID, TIME, TARGET])
    static = [c for c in df.columns if c not in (ID, TIME, TARGET)]
    if on_duplicate == "first":
        row = F.struct(
            F.col(TARGET).isNull().alias("_unknown"),
            *[F.col(c) for c in (TARGET, *static)],
        )
        best = merge_keys(df.select(ID, TIME, row.alias("_row")), {"_row": F.min}, partitions)
        return best.select(ID, TIME, *[F.col("_row")[c].alias(c) for c in (TARGET, *static)])
    if on_duplicate not in ("error", "sum"):
        raise ValueError("on_duplicate must be 'error', 'sum' or 'first'")
    how = {TARGET: F.sum, **dict.fromkeys(static, F.max), "_rows": F.sum}
    merged = merge_keys(df.withColumn("_rows", F.lit(1)), how, partitions)
    if on_duplicate == "error":
        message = F.concat(
            F.lit("Duplicate key: "), F.col(ID), F.lit(" "), F.col(TIME).cast("string")
        )
        merged = merged.where(
            F.when(F.col("_rows") == 1, F.lit(True)).otherwise(
                F.raise_error(message).cast("boolean")
            )
        )
    return merged.select(ID, TIME, TARGET, *static)


def read_series(
    spark: SparkSession,
    source: str,
    id_column: str,
    time_column: str,
    target_column: str,
    static: Sequence[str] | None = None,
    on_duplicate: str = "error",
    mode: str = "strict",
    after: datetime.date | str | None = None,
    until: datetime.date | str | None = None,
) -> DataFrame:
    """Read a raw table as a standard panel with unique keys."""
    rows = standardise(
        read_table(spark, source), id_column, time_column, target_column,
        static, mode, after, until,
    )
    return unique_keys(rows, on_duplicate)


def inbound(df: DataFrame) -> DataFrame:
    """Cast the key and target of a panel and keep one row per key."""
    require_columns(df, [ID, TIME, TARGET])
    typed = df.withColumns(
        {
            ID: F.col(ID).cast("string"),
            TIME: F.to_date(TIME),
            TARGET: F.col(TARGET).cast("double"),
        }
    )
    return unique_keys(typed, "first")


def split_at(
    df: DataFrame, date: datetime.date | str, check: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including the date, and rows after it; with ``check`` a side without rows
    raises when it is read."""
    require_columns(df, [TIME])
    train = df.where(F.col(TIME) <= _day(date))
    test = df.where(F.col(TIME) > _day(date))
    if check:
        return require_rows(train, "train"), require_rows(test, "test")
    return train, test


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """The same rows; reading them raises where there are none.

    The check is part of the plan: an aggregate over at most one row a partition, whose filter lets nothing
    through, and raises if it has counted nothing. Building it runs no job.
    """
    problem = F.raise_error(F.lit(f"No rows in: {name}")).cast("boolean")
    counted = df.limit(1).agg(F.count(F.lit(1)).alias("_n"))
    # In a filter, which no reader of fewer columns leaves out.
    none = counted.where(F.when(F.col("_n") == 0, problem).otherwise(F.lit(False)))
    return df.unionByName(none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]))


def dataset_bounds(**frames: DataFrame) -> DataFrame:
    """``dataset, min_ds, max_ds`` of the named frames, in one plan."""
    parts = [
        frame.agg(F.min(TIME).alias("min_ds"), F.max(TIME).alias("max_ds")).select(
            F.lit(name).alias("dataset"), "min_ds", "max_ds"
        )
        for name, frame in frames.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _training_columns(
    df: DataFrame, exogenous: Sequence[str] | None, static: Sequence[str] | None
) -> list[str]:
    if exogenous is None:
        raise ValueError("exogenous columns must be given (an empty list is allowed)")
    columns = [ID, TIME, TARGET, LABEL, *exogenous, *(static or [])]
    require_columns(df, columns)
    return columns


def read_training(
    spark: SparkSession,
    source: str,
    exogenous: Sequence[str],
    static: Sequence[str] | None = None,
) -> DataFrame:
    table = read_table(spark, source)
    return table.select(*_training_columns(table, exogenous, static))


def write_training(
    df: DataFrame,
    table: str,
    exogenous: Sequence[str],
    static: Sequence[str] | None = None,
    partition_by_label: bool = False,
    buckets: int | None = None,
) -> None:
    """Overwrite the training table; a missing target is stored as zero.

    Forecasting reads one label at a time and works per series: ``partition_by_label``
    lets it skip files, ``buckets`` (by series, sorted by date) lets its windows start
    without a shuffle.
    """
    require_text("table", table)
    rows = df.select(*_training_columns(df, exogenous, static)).withColumns(
        {
            ID: F.col(ID).cast("string"),
            TIME: F.to_date(TIME),
            TARGET: F.coalesce(F.col(TARGET).cast("double"), F.lit(0.0)),
        }
    )
    if buckets:
        # One task per bucket writes one file per bucket and label.
        rows = rows.repartition(buckets, ID)
    writer: DataFrameWriter = rows.write.mode("overwrite")
    if partition_by_label:
        writer = writer.partitionBy(LABEL)
    if buckets:
        writer = writer.bucketBy(buckets, ID).sortBy(ID, TIME)
    writer.saveAsTable(table)


def write_future(
    df: DataFrame, table: str, exogenous: Sequence[str], buckets: int | None = None
) -> None:
    """Overwrite the table of coming periods: ``unique_id, ds`` and the exogenous columns.

    With as many ``buckets`` as the training table, forecasts join the two without a shuffle.
    """
    require_text("table", table)
    require_columns(df, [ID, TIME, *exogenous])
    rows = df.select(F.col(ID).cast("string").alias(ID), F.to_date(TIME).alias(TIME), *exogenous)
    if buckets:
        rows = rows.repartition(buckets, ID)
    writer: DataFrameWriter = rows.write.mode("overwrite")
    if buckets:
        writer = writer.bucketBy(buckets, ID).sortBy(ID, TIME)
    writer.saveAsTable(table)


def read_future(spark: SparkSession, source: str, exogenous: Sequence[str]) -> DataFrame:
    table = read_table(spark, source)
    require_columns(table, [ID, TIME, *exogenous])
    return table.select(ID, TIME, *exogenous)


def _stamped(df: DataFrame, version: str) -> DataFrame:
    require_columns(df, [ID, TIME, "y_pred"])
    return df.select(
        F.col(ID).cast("string").alias(ID),
        F.to_date(TIME).alias(TIME),
        F.col("y_pred").cast("double").alias("y_pred"),
        F.current_timestamp().alias("process_date"),
        F.lit(version).cast("string").alias("version"),
    )


def append_forecasts(df: DataFrame, version: str, table: str) -> None:
    """Append forecasts, stamped with the time of writing and a version; what the version has stays."""
    require_text("table", table)
    rows = _stamped(df, version)
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        rows.select(*spark.table(table).columns).write.insertInto(table)
    else:
        rows.write.partitionBy("version").saveAsTable(table)


def replace_forecasts(df: DataFrame, version: str, table: str) -> None:
    """Write forecasts as the only ones of their version; other versions stay as they are.

    The table is partitioned by version and one partition is overwritten, also by no rows, so
    a job that is run again, or was broken off, leaves one result. ``df`` must not read that version.
    """
    require_text("table", table)
    require_text("version", version)
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        append_forecasts(df, version, table)
        return
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if parts != ["version"]:
        raise ValueError(f"{table} is not partitioned by version alone, so none can be replaced")
    columns = [c for c in spark.table(table).columns if c != "version"]
    spark.sql(
        "INSERT OVERWRITE TABLE IDENTIFIER(:table) PARTITION (version = :version) "
        f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {{rows}}",
        args={"table": table, "version": version},
        rows=_stamped(df, version),
    )
