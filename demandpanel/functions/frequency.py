"""Calendar frequencies as column expressions.

Every frequency numbers its base periods with an integer index (days, working
days, weeks, half months or months), so a calendar is an arithmetic sequence of integers that
Spark can generate, compare and turn back into dates without driver-side data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday and month names of offset aliases, in calendar order.
WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

# Alias -> (unit, base periods per anchor, default anchor name).
ALIASES = {
    "D": ("day", 1, None),
    "B": ("workday", 1, None),
    "W": ("week", 1, "SUN"),
    "MS": ("month_start", 1, None),
    "ME": ("month_end", 1, None),
    "M": ("month_end", 1, None),
    "QS": ("month_start", 3, "JAN"),
    "QE": ("month_end", 3, "DEC"),
    "Q": ("month_end", 3, "DEC"),
    "YS": ("month_start", 12, "JAN"),
    "AS": ("month_start", 12, "JAN"),
    "YE": ("month_end", 12, "DEC"),
    "Y": ("month_end", 12, "DEC"),
    "A": ("month_end", 12, "DEC"),
    "BMS": ("workmonth_start", 1, None),
    "BME": ("workmonth_end", 1, None),
    "BM": ("workmonth_end", 1, None),
    "BQS": ("workmonth_start", 3, "JAN"),
    "BQE": ("workmonth_end", 3, "DEC"),
    "BYS": ("workmonth_start", 12, "JAN"),
    "BYE": ("workmonth_end", 12, "DEC"),
    "SMS": ("half_month_start", 1, None),
    "SME": ("half_month_end", 1, None),
    "SM": ("half_month_end", 1, None),
}
# Fixed value: the second anchor of a month in two parts, where an alias names no other.
MIDDLE = 15


@dataclass(frozen=True)
class Frequency:
    """A calendar of anchors: every ``multiple``-th index congruent to ``anchor``.

    ``base`` is the distance between neighbouring anchors in index units (1 day,
    3 months per quarter, ...). With a multiple above one the calendar counts from
    its first anchor, so the grid also needs that first index. Half months have two
    indices a month; their ``anchor`` is the day in the middle.
    """

    unit: str
    base: int = 1
    anchor: int = 0
    multiple: int = 1

    @property
    def step(self) -> int:
        return self.base * self.multiple

    def _month_index(self, ds: Column) -> Column:
        return (F.year(ds) * 12 + F.month(ds) - 1).cast("int")

    def _month_date(self, month: Column) -> Column:
        """Date that stands for a month: its first or last day, or weekday."""
        first = F.make_date(
            F.floor(month / 12).cast("int"), F.pmod(month, F.lit(12)) + 1, F.lit(1)
        )
        if self.unit == "month_start":
            return first
        last = F.last_day(first)
        if self.unit == "month_end":
            return last
        # Saturday is 5, Sunday 6.
        if self.unit == "workmonth_start":
            day = F.weekday(first)
            return F.date_add(first, F.when(day >= 5, F.lit(7) - day).otherwise(F.lit(0)))
        return F.date_sub(last, F.greatest(F.weekday(last) - 4, F.lit(0)))

    def _half(self, ds: Column, up: bool) -> Column:
        """Index of the half month's anchor on or after (``up``), or on or before ``ds``."""
        day, double = F.dayofmonth(ds), self._month_index(ds) * 2
        # Days that come before each anchor of the month: 1st and middle, or middle and last.
        ends = [F.lit(1), F.lit(self.anchor)] if self.unit == "half_month_start" else [
            F.lit(self.anchor), F.dayofmonth(F.last_day(ds))
        ]
        if up:
            return double + (day > ends[0]).cast("int") + (day > ends[1]).cast("int")
        return double - 1 + (day >= ends[0]).cast("int") + (day >= ends[1]).cast("int")

    def _offset(self, distance: Column) -> Column:
        """Distance to an anchor, as less than one base; every index is one at base 1."""
        return F.lit(0) if self.base == 1 else F.pmod(distance, F.lit(self.base))

    def ceil(self, ds: Column) -> Column:
        """Index of the first anchor on or after ``ds``."""
        if self.unit == "day":
            return F.unix_date(ds)
        if self.unit == "workday":
            monday_based = F.unix_date(ds) + 3
            week = F.floor(monday_based / 7)
            return (week * 5 + F.least(F.pmod(monday_based, F.lit(7)), F.lit(5))).cast("int")
        if self.unit == "week":
            return F.ceil((F.unix_date(ds) + 3 - self.anchor) / 7).cast("int")
        if self.unit.startswith("half"):
            return self._half(ds, up=True)
        month = self._month_index(ds)
        month = month + (ds > self._month_date(month)).cast("int")
        return month + self._offset(F.lit(self.anchor) - month)

    def floor(self, ds: Column) -> Column:
        """Index of the last anchor on or before ``ds``."""
        if self.unit == "day":
            return F.unix_date(ds)
        if self.unit == "workday":
            monday_based = F.unix_date(ds) + 3
            week = F.floor(monday_based / 7)
            return (week * 5 + F.least(F.pmod(monday_based, F.lit(7)), F.lit(4))).cast("int")
        if self.unit == "week":
            return F.floor((F.unix_date(ds) + 3 - self.anchor) / 7).cast("int")
        if self.unit.startswith("half"):
            return self._half(ds, up=False)
        month = self._month_index(ds)
        month = month - (ds < self._month_date(month)).cast("int")
        return month - self._offset(month - F.lit(self.anchor))

    def date_of(self, index: Column) -> Column:
        """Date of an anchor index."""
        if self.unit == "day":
            return F.date_from_unix_date(index)
        if self.unit == "workday":
            days = F.floor(index / 5) * 7 + F.pmod(index, F.lit(5)) - 3
            return F.date_from_unix_date(days.cast("int"))
        if self.unit == "week":
            return F.date_from_unix_date(index * 7 + (self.anchor - 3))
        if self.unit.startswith("half"):
            month, second = F.floor(index / 2).cast("int"), F.pmod(index, F.lit(2)) == 1
            first = F.make_date(
                F.floor(month / 12).cast("int"), F.pmod(month, F.lit(12)) + 1, F.lit(1)
            )
            middle = F.date_add(first, self.anchor - 1)
            if self.unit == "half_month_start":
                return F.when(second, middle).otherwise(first)
            return F.when(second, F.last_day(first)).otherwise(middle)
        return self._month_date(index)

    def snap(self, index: Column, first: Column) -> Column:
        """Smallest grid index not below ``index``, the grid counting from ``first``."""
        if self.multiple == 1:
            return index
        return index + F.pmod(first - index, F.lit(self.step))

    def snap_down(self, index: Column, first: Column) -> Column:
        """Largest grid index not above ``index``, the grid counting from ``first``."""
        if self.multiple == 1:
            return index
        return index - F.pmod(index - first, F.lit(self.step))

    def on_grid(self, ds: Column, first: Column) -> Column:
        """Whether ``ds`` is a calendar date, the grid counting from ``first``."""
        index = self.ceil(ds)
        anchored = self.date_of(index) == ds
        if self.multiple == 1:
            return anchored
        return anchored & (F.pmod(index - first, F.lit(self.step)) == 0)


def parse_frequency(alias: str | Frequency) -> Frequency:
    """Read an offset alias such as ``D``, ``2W-MON``, ``MS``, ``BME``, ``QS-FEB`` or ``SMS-16``."""
    if isinstance(alias, Frequency):
        return alias
    match = re.fullmatch(r"(\d*)([A-Z]+)(?:-([A-Z]{3}|\d{1,2}))?", (alias or "").strip())
    if not match or match.group(2) not in ALIASES:
        raise ValueError(f"Unsupported frequency {alias!r}; use one of {sorted(ALIASES)}")
    unit, base, default_anchor = ALIASES[match.group(2)]
    multiple = int(match.group(1) or 1)
    if multiple < 1:
        raise ValueError(f"Frequency multiple must be positive: {alias!r}")
    if unit.startswith("half"):
        middle = match.group(3) or str(MIDDLE)
        if not middle.isdigit() or not 2 <= int(middle) <= 27:
            raise ValueError(f"Unsupported anchor in frequency {alias!r}")
        return Frequency(unit, 1, int(middle), multiple)
    name = match.group(3) or default_anchor
    names = WEEKDAYS if unit == "week" else MONTHS
    if match.group(3) and default_anchor is None or name and name not in names:
        raise ValueError(f"Unsupported anchor in frequency {alias!r}")
    anchor = names.index(name) if name else 0
    return Frequency(unit, base, anchor if unit == "week" else anchor % base, multiple)
