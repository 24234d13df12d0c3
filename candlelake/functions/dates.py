"""Calendar arithmetic shared by the date dimension and the time ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Selectable time ranges in display order.
TIME_RANGES = (
    ("30 Days", 1),
    ("90 Days", 2),
    ("YTD", 3),
    ("1Y", 4),
    ("5Y", 5),
    ("MAX", 6),
)
RANGE_NAMES = tuple(name for name, _ in TIME_RANGES)
DEFAULT_RANGE = "30 Days"


def date_id(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def years_before(day: Column, years: int) -> Column:
    """Same month and day ``years`` earlier; Feb 29 rolls over to Mar 1."""
    first = F.make_date(F.year(day) - years, F.month(day), F.lit(1))
    return F.date_add(first, F.dayofmonth(day) - 1)


def range_start(name: str, anchor: Column) -> Column:
    """First day of a range ending on ``anchor``; NULL for the unbounded range."""
    match name:
        case "30 Days" | "90 Days":
            return F.date_sub(anchor, int(name.split()[0]))
        case "YTD":
            return F.make_date(F.year(anchor), F.lit(1), F.lit(1))
        case "1Y" | "5Y":
            return years_before(anchor, int(name[:-1]))
        case "MAX":
            return F.lit(None).cast("date")
    raise ValueError(f"unknown range {name!r}; expected one of {', '.join(RANGE_NAMES)}")


def in_range(name: str, day: Column, anchor: Column) -> Column:
    """True inside the range, both ends included; the unbounded range takes every day."""
    if name == "MAX":
        return F.lit(True)
    return day.between(range_start(name, anchor), anchor)
