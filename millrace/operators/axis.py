"""Time axes as frames: numbered points, observed or regular, and every series on them.

No axis is ever one array or one task. Observed points are numbered by sorted ranges (``scale.numbered``). Regular points
come from ``spark.range`` by arithmetic on their place. A series gets the axis by an equi-join on step numbers, each
standing for up to ``STEP`` neighbouring points.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.functions.grains import CALENDAR_GRAINS, SECOND_GRAINS, WEEK_GRAINS, moment, ntz
from millrace.operators.scale import numbered

POS = "__pos"
#: Points that one row of an axis carries while it is given to the series.
STEP = 4_096

_DAY = 86_400_000_000


def micros(col: Column | str) -> Column:
    """Microseconds since 1970 of a wall-clock time."""
    return F.timestamp_diff("MICROSECOND", moment(datetime(1970, 1, 1)), ntz(col))


def observed_axis(df: DataFrame, time: str) -> DataFrame:
    """(place, time): the distinct known times, numbered from 0."""
    return numbered(df.select(time).where(F.col(time).isNotNull()).distinct(), [time], POS)


def on_axis(df: DataFrame, series: Sequence[str], axis: DataFrame) -> DataFrame:
    """Each observed series on each point of ``axis``, whose ``POS`` counts from 0 without gaps."""
    if not series:
        return axis
    step = F.floor(F.col(POS) / STEP)
    steps = axis.groupBy(step.alias("__step")).agg(F.collect_list(F.struct(*axis.columns)).alias("__points"))
    last = axis.agg(F.max(step)).scalar()
    known = df.select(*series).distinct().withColumn("__step", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return known.join(steps, "__step").select(*series, F.inline("__points"))


@dataclass(frozen=True)
class Rule:
    """Cells of a regular grid: each ``amount`` units, known by its first moment or, with ``ends``, by its last day.

    ``unit`` is micros (``width`` each, counted from the midnight before the first time), week (beginning ``width`` days
    before a Thursday) or month (``width`` to a unit: 1, 3 or 12).
    """

    unit: str
    width: int
    amount: int = 1
    ends: bool = False

    def _cell(self, col: Column) -> Column:
        if self.unit == "month":
            return F.floor((F.year(col) * 12 + F.month(col) - 1) / self.width)
        if self.unit == "week":
            return F.floor((F.unix_date(col.cast("date")) + self.width) / 7)
        return micros(col)

    def over(self, df: DataFrame, time: str) -> Grid:
        """The grid from the cell of the first time to that of the last; nothing for a frame without times."""
        at = ntz(time)
        row = df.agg(self._cell(F.min(at)).alias("low"), self._cell(F.max(at)).alias("high")).first()
        if row["low"] is None:
            return Grid(self, 0, 0)
        low, high = int(row["low"]), int(row["high"])
        if self.unit == "micros":
            midnight, width = low - low % _DAY, self.width * self.amount
            low = midnight + (low - midnight) // width * width
            return Grid(self, low, (high - low) // width + 1)
        distance = high - low
        return Grid(self, low, (-(-distance // self.amount) if self.ends else distance // self.amount) + 1)


@dataclass(frozen=True)
class Grid:
    """A rule with its first cell and its number of cells."""

    rule: Rule
    first: int
    size: int

    def place(self, col: Column | str) -> Column:
        """The number, from 0, of the cell that holds a time of the extent."""
        rule, distance = self.rule, self.rule._cell(ntz(col)) - F.lit(self.first)
        if rule.unit == "micros":
            return F.floor(distance / (rule.width * rule.amount))
        return F.ceil(distance / rule.amount) if rule.ends else F.floor(distance / rule.amount)

    def label(self, place: Column) -> Column:
        """The time that stands for a cell."""
        rule = self.rule
        cell = F.lit(self.first) + place * F.lit(rule.amount * (rule.width if rule.unit == "micros" else 1))
        if rule.unit == "micros":
            return F.timestamp_add("MICROSECOND", cell, moment(datetime(1970, 1, 1)))
        if rule.unit == "week":
            return F.timestamp_add("DAY", cell * 7 - rule.width + (6 if rule.ends else 0), moment(datetime(1970, 1, 1)))
        month = cell * rule.width + (rule.width - 1 if rule.ends else 0)
        day = F.make_date(F.floor(month / 12).cast("int"), (F.pmod(month, F.lit(12)) + 1).cast("int"), F.lit(1))
        return ntz(F.last_day(day) if rule.ends else day)

    def axis(self, spark: SparkSession, time: str) -> DataFrame:
        """(place, time) of all cells."""
        places = spark.range(0, self.size, 1, self.size // 100_000 + 1)
        return places.select(F.col("id").alias(POS), self.label(F.col("id")).alias(time))


# Names of time units in resample rules.
_MICROS = {
    "us": 1, "U": 1, "ms": 1_000, "L": 1_000, "s": 1_000_000, "S": 1_000_000, "T": 60_000_000, "min": 60_000_000,
    "h": 3_600_000_000, "H": 3_600_000_000, "D": _DAY,
}
_MONTHS = {
    "MS": (1, False), "M": (1, True), "ME": (1, True), "QS": (3, False), "Q": (3, True), "QE": (3, True),
    "AS": (12, False), "YS": (12, False), "A": (12, True), "Y": (12, True), "YE": (12, True),
}
_WEEKDAYS = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]


def rule_of(text: str) -> Rule:
    """A time grain, or a number and a unit: ``7D``, ``90T``, ``1MS`` (month start), ``1M`` (month end), ``1A``, ``W-SAT``."""
    if text in CALENDAR_GRAINS:
        unit = CALENDAR_GRAINS[text]
        if unit in ("month", "quarter", "year"):
            return Rule("month", {"month": 1, "quarter": 3, "year": 12}[unit])
        return Rule("week", 3) if unit == "week" else Rule("micros", {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit] * 1_000_000)
    if text in SECOND_GRAINS:
        return Rule("micros", SECOND_GRAINS[text] * 1_000_000)
    if text in WEEK_GRAINS:
        before, after = WEEK_GRAINS[text]
        return Rule("week", 3 + before, ends=after > 0)
    found = re.fullmatch(r"(\d*)([A-Za-z]+)(?:-([A-Z]{3}))?", text or "")
    amount = int(found[1] or 1) if found else 0
    unit, day = (found[2], found[3]) if found else ("", None)
    if amount:
        if unit in _MICROS and not day:
            return Rule("micros", _MICROS[unit], amount)
        if unit in _MONTHS and not day:
            months, ends = _MONTHS[unit]
            return Rule("month", months, amount, ends)
        if unit == "W" and (day or "SUN") in _WEEKDAYS:
            # the week that ends on Sunday begins on Monday, three days before a Thursday
            return replace(Rule("week", (2 - _WEEKDAYS.index(day or "SUN")) % 7), amount=amount, ends=True)
    raise QueryError(f"unknown resample rule: {text}")
