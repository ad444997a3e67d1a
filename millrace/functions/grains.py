"""Time grains and time normalisation (PR4-PR7, DT2-DT4, DT8)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.errors import QueryError

# Grain names.
CALENDAR_GRAINS = {
    "PT1S": "second",
    "PT1M": "minute",
    "PT1H": "hour",
    "P1D": "day",
    "P1W": "week",
    "P1M": "month",
    "P3M": "quarter",
    "P1Y": "year",
}
SECOND_GRAINS = {
    "PT5S": 5,
    "PT30S": 30,
    "PT5M": 300,
    "PT10M": 600,
    "PT15M": 900,
    "PT30M": 1800,
    "PT6H": 21600,
}
# Week grains: (days added before truncating to Monday, days added after).
WEEK_GRAINS = {
    "1969-12-28T00:00:00Z/P1W": (1, -1),
    "1969-12-29T00:00:00Z/P1W": (0, 0),
    "P1W/1970-01-03T00:00:00Z": (1, 5),
    "P1W/1970-01-04T00:00:00Z": (0, 6),
}
GRAINS = [*CALENDAR_GRAINS, *SECOND_GRAINS, *WEEK_GRAINS, None]


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz(col: Column | str) -> Column:
    """Wall-clock timestamp: grains never depend on a zone."""
    return as_column(col).cast("timestamp_ntz")


def moment(value: datetime) -> Column:
    """A wall-clock literal: independent of the driver's and the session's zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _epoch() -> Column:
    return moment(datetime(1970, 1, 1))


def truncate(unit: str, col: Column | str) -> Column:
    return F.date_trunc(unit, ntz(col)).cast("timestamp_ntz")


def shift(col: Column | str, unit: str, amount: Column | int) -> Column:
    """Calendar shift; months clamp at the month end."""
    amount = F.lit(amount) if isinstance(amount, int) else amount
    return F.timestamp_add(unit.upper(), amount, ntz(col))


def time_bucket(col: Column | str, grain: str | None) -> Column:
    """PR4: the start (or, for week-ending grains, the end day) of the bucket holding ``col``."""
    if grain is None:
        return as_column(col)
    if grain in CALENDAR_GRAINS:
        return truncate(CALENDAR_GRAINS[grain], col)
    if grain in SECOND_GRAINS:
        width = SECOND_GRAINS[grain]
        seconds = F.timestamp_diff("SECOND", _epoch(), truncate("second", col))
        return F.timestamp_add("SECOND", seconds - F.pmod(seconds, F.lit(width)), _epoch())
    if grain in WEEK_GRAINS:
        before, after = WEEK_GRAINS[grain]
        moved = shift(col, "day", before) if before else ntz(col)
        week = truncate("week", moved)
        return shift(week, "day", after) if after else week
    raise QueryError(f"unknown time grain: {grain}")


def epoch_to_ts(col: Column | str, unit: str) -> Column:
    """PR5: integer epoch to timestamp."""
    if unit == "epoch_s":
        return F.timestamp_add("SECOND", as_column(col).cast("bigint"), _epoch())
    if unit == "epoch_ms":
        millis = as_column(col).cast("bigint")
        return F.timestamp_add("MICROSECOND", millis * F.lit(1000), _epoch())
    raise QueryError(f"unknown epoch unit: {unit}")


def normalize_time(
    df: DataFrame,
    col: str,
    fmt: str | None = None,
    offset_hours: int = 0,
    time_shift: tuple[str, int] | None = None,
) -> DataFrame:
    """PR6: parse, then add the dataset's hour offset and an optional shift. Unparsable -> null."""
    source = F.col(col)
    if fmt in ("epoch_s", "epoch_ms"):
        value = epoch_to_ts(source, fmt)
    elif fmt:
        value = F.try_to_timestamp(source.cast("string"), F.lit(fmt)).cast("timestamp_ntz")
    elif dict(df.dtypes)[col] == "string":
        value = source.try_cast("timestamp_ntz")
    else:
        value = ntz(source)
    if offset_hours:
        value = shift(value, "hour", offset_hours)
    if time_shift:
        value = shift(value, *time_shift)
    return df.withColumn(col, value)


def add_date_parts(df: DataFrame, col: str) -> DataFrame:
    """PR7: ``year, month, day`` of an epoch-seconds column."""
    at = epoch_to_ts(col, "epoch_s")
    return df.withColumns(
        {"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)}
    )


def date_add_units(col: Column | str, amount: int, unit: str) -> Column:
    """DT2 on a column."""
    unit = unit.lower()
    return shift(col, "month", 3 * amount) if unit == "quarter" else shift(col, unit, amount)


def last_day_of(col: Column | str, unit: str) -> Column:
    """DT4 on a column: last day of the year, month or (Monday-based) week, at midnight."""
    if unit == "year":
        return shift(shift(truncate("year", col), "year", 1), "day", -1)
    if unit == "month":
        return ntz(F.last_day(ntz(col)))
    if unit == "week":
        return shift(truncate("week", col), "day", 6)
    raise QueryError(f"last day of {unit} is not defined")


def bin_width(col: Column | str, width: float) -> Column:
    """Lower edge of the fixed-width bin."""
    return as_column(col) - F.pmod(as_column(col), F.lit(width))


# Date-part formats and their meaning.
DATE_PARTS = {
    "%y": "yyyy",
    "%m": "MM",
    "%n": "MMM",
    "%d": "dd",
    "%w": "EEE",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
}


def date_part_label(col: Column | str, template: str) -> Column:
    """Format a date by parts; ``%x`` is the weekday number, Sunday = 0."""
    pieces, rest = [], template
    while rest:
        token = rest[:2]
        if token == "%x":
            pieces.append((F.dayofweek(ntz(col)) - 1).cast("string"))
            rest = rest[2:]
        elif token in DATE_PARTS:
            pieces.append(F.date_format(ntz(col), DATE_PARTS[token]))
            rest = rest[2:]
        else:
            pieces.append(F.lit(rest[0]))
            rest = rest[1:]
    return F.concat(*pieces)
