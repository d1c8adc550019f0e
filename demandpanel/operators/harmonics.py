"""Sine and cosine features on the period index.

The angle of a row is the number of its calendar period over the length of a season, so history and
future of every series get the same values for the same date without looking at each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandpanel.functions.columns import TIME, require_columns
from demandpanel.functions.frequency import Frequency, parse_frequency


def harmonic_names(seasons: Mapping[int, int]) -> list[str]:
    """Columns of ``harmonic_features``: sine and cosine of each order of each season."""
    return [
        f"{wave}_{length}_{order}"
        for length, orders in seasons.items()
        for order in range(1, orders + 1)
        for wave in ("sin", "cos")
        if not (wave == "sin" and 2 * order == length)  # zero on every period
    ]


def harmonic_features(
    freq: str | Frequency, seasons: Mapping[int, int]
) -> Callable[[DataFrame], DataFrame]:
    """A feature function that adds ``harmonic_names(seasons)``.

    ``seasons`` maps season lengths, in periods of ``freq``, to the number of orders, at most half
    the length. Dates between two periods count as the period before. The index is reduced to the
    season before it becomes an angle, so distant dates are as exact as near ones.
    """
    f = parse_frequency(freq)
    for length, orders in seasons.items():
        if length < 2 or not 1 <= orders <= length // 2:
            raise ValueError(f"A season of {length} periods has 1 to {length // 2} orders, not {orders}")

    def wave(name: str) -> Column:
        kind, length, order = name.split("_")
        whole = int(length) * f.step
        place = F.pmod(f.floor(F.col(TIME)).cast("long") * int(order), F.lit(whole))
        angle = place * F.lit(2 * math.pi / whole)
        return F.sin(angle) if kind == "sin" else F.cos(angle)

    def feature(df: DataFrame) -> DataFrame:
        require_columns(df, [TIME])
        return df.withColumns({name: wave(name) for name in harmonic_names(seasons)})

    return feature
