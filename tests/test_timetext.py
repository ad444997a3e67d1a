"""Time text with the clock fixed at 2023-03-31 14:05:06, a Friday at a month's and a quarter's end."""

from datetime import datetime

import pytest

from millrace.errors import QueryError
from millrace.functions.timetext import TimeText, last_day, moment, offset_of, truncated

NOW = datetime(2023, 3, 31, 14, 5, 6)
TODAY = datetime(2023, 3, 31)
CLOCK = TimeText(NOW, holidays={("Harvest", 2023, "US"): datetime(2023, 9, 24)})


@pytest.mark.parametrize(
    "text, low, high",
    [
        ("yesterday : now", datetime(2023, 3, 30), NOW),
        (" : today", None, TODAY),
        ("tomorrow : ", datetime(2023, 4, 1), None),
        ("1999-12-31 : 2000-01-01T06:00:00", datetime(1999, 12, 31), datetime(2000, 1, 1, 6)),
        ("No filter", None, None),
        # months end where the shorter month ends
        ("Last 3 weeks", datetime(2023, 3, 10), TODAY),
        ("Last month", datetime(2023, 2, 28), TODAY),
        ("Last 2 quarters", datetime(2022, 9, 30), TODAY),
        ("Next 11 months", TODAY, datetime(2024, 2, 29)),
        ("Next year", TODAY, datetime(2024, 3, 31)),
        ("previous calendar week", datetime(2023, 3, 20), datetime(2023, 3, 27)),
        ("previous calendar month", datetime(2023, 2, 1), datetime(2023, 3, 1)),
        ("previous calendar year", datetime(2022, 1, 1), datetime(2023, 1, 1)),
        # four months back is November 2022; February 2024 has 29 days
        ("DATETRUNC(DATEADD(DATETIME('today'), -4, month), year) : LASTDAY(DATETIME('2024-02-10'), month)", datetime(2022, 1, 1), datetime(2024, 2, 29)),
        ("HOLIDAY('Harvest') : DATEADD(DATETIME('2023-11-30'), 1, quarter)", datetime(2023, 9, 24), datetime(2024, 2, 29)),
    ],
)
def test_ranges(text, low, high):
    assert CLOCK.time_range(text) == (low, high)


def test_since_until_and_shift():
    assert CLOCK.time_range(since="2 weeks", until="tomorrow") == (datetime(2023, 3, 17), datetime(2023, 4, 1))
    assert CLOCK.time_range() == (None, TODAY)
    shifted = CLOCK.time_range(since="yesterday", until="today", time_shift="2 days")
    assert shifted == (datetime(2023, 3, 28), datetime(2023, 3, 29))
    assert CLOCK.time_range("Last 3 weeks", relative_end="now")[1] == NOW


@pytest.mark.parametrize("unit, low", [
    ("second", datetime(2023, 3, 31, 14, 5, 2)), ("minute", datetime(2023, 3, 31, 14, 1, 6)), ("hour", datetime(2023, 3, 31, 10, 5, 6)),
    ("month", datetime(2022, 11, 30)), ("quarter", datetime(2022, 3, 31)), ("year", datetime(2019, 3, 31)),
])
def test_since_takes_every_unit(unit, low):
    assert CLOCK.time_range(since=f"4 {unit}s", until="now") == (low, NOW)


def test_reversed_range_and_ambiguity():
    with pytest.raises(QueryError):
        CLOCK.time_range("now : yesterday")
    for text in ("3 weeks", " 12 hours"):
        with pytest.raises(QueryError):
            moment(text, NOW)
    with pytest.raises(QueryError):
        moment("when it rains", NOW)
    with pytest.raises(QueryError):
        CLOCK.evaluate("HOLIDAY('Thaw')")


def test_offsets():
    assert offset_of("6 hours ago") == ("hour", -6)
    assert offset_of("2 quarters later") == ("quarter", 2)
    with pytest.raises(QueryError):
        offset_of("some time ago")


def test_units():
    assert truncated(NOW, "week") == datetime(2023, 3, 27)
    assert truncated(NOW, "hour") == datetime(2023, 3, 31, 14)
    assert last_day(datetime(2023, 4, 15, 1), "month") == datetime(2023, 4, 30)
    assert last_day(datetime(2023, 3, 29), "week") == datetime(2023, 4, 2)
