"""Shared checks and column expressions on panels."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

ID, TIME, TARGET, LABEL = "unique_id", "ds", "y", "classification"

# The four demand labels.
LABELS = ("Smooth", "Intermittent", "Erratic", "Lumpy")


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}; present: {df.columns}")


def require_text(name: str, value: str | None) -> str:
    if value is None or not str(value).strip():
        raise ValueError(f"{name} must be a non-blank string")
    return value


def by_series() -> WindowSpec:
    """All rows of a series. Keys are unique, so a group never exceeds the calendar."""
    return Window.partitionBy(ID)


def in_time() -> WindowSpec:
    return Window.partitionBy(ID).orderBy(TIME)


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean over columns of one row, nulls skipped; null when all are null."""
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])
    return F.when(present > 0, total / present)
