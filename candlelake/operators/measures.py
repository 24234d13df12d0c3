"""Measures over the star, under a grouping and a time range.

A star here is any DataFrame with ``Date``, ``Open``, ``High``, ``Low``, ``Close``, ``Volume``
and the grouping columns. Everything starts from :func:`daily`: one row per group and day.
That is at most the calendar's length per group however many facts a group holds, so later
steps may safely bring all days of a group together.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlelake.functions.dates import DEFAULT_RANGE, RANGE_NAMES, TIME_RANGES, in_range, range_start
from candlelake.functions.values import growth, ratio

# -- plain aggregates -----------------------------------------------------------------------

def base_measures() -> dict[str, Column]:
    return {
        "SumClose": F.sum("Close").cast("double"),
        "SumOpen": F.sum("Open").cast("double"),
        "MinLow": F.min("Low").cast("double"),
        "MaxHigh": F.max("High").cast("double"),
        "AvgVolume": F.avg("Volume"),
        "MinDate": F.min("Date"),
        "MaxDate": F.max("Date"),
        "AvgGain": F.avg(ratio(F.col("Close") - F.col("Open"), F.col("Open"))),
    }


def measure(star: DataFrame, names: Iterable[str], by: Sequence[str] = ()) -> DataFrame:
    """Named measures per group; without ``by`` one row for everything."""
    known = base_measures()
    return star.groupBy(*by).agg(*(known[name].alias(name) for name in names))


def _members(star: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Distinct values per group. Text cannot be an aggregation buffer, but it can be a hashed
    key: facts collapse to members before anything is sorted or shuffled."""
    return star.select(*by, column).distinct()


def max_text(star: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return _members(star, column, by).groupBy(*by).agg(F.max(column).alias(column))


def selected_value(star: DataFrame, column: str, by: Sequence[str] = (), default: object = None,
                   name: str | None = None) -> DataFrame:
    """The single distinct value in the group, else the default; a blank is a value of its own."""
    only = F.when(F.count(F.lit(1)) == 1, F.max(column)).otherwise(F.lit(default))
    return _members(star, column, by).groupBy(*by).agg(only.alias(name or column))


# -- days, anchors, ranges ------------------------------------------------------------------

def daily(star: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Additive parts of the measures per group and day.

    Facts are summed per day on the map side before they move, so a hot group (an industry,
    the whole market, the blank member of all unknown symbols) never meets in one task.
    """
    return star.groupBy(*by, "Date").agg(
        F.sum("Open").alias("SumOpen"),
        F.sum("Close").alias("SumClose"),
        F.min("Low").alias("MinLow"),
        F.max("High").alias("MaxHigh"),
        F.sum("Volume").alias("SumVolume"),
        F.count("Volume").alias("CountVolume"))


def _group(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def _traded(total: str) -> Column:
    return F.when(F.col(total) > 0, F.col("Date"))


def _inside(name: str) -> Column:
    return in_range(name, F.col("Date"), F.col("LastTradingDate"))


def with_last_date(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each day with its group's last trading date, whatever dates are shown."""
    return days.withColumn("LastTradingDate", F.max(_traded("SumClose")).over(_group(by)))


def last_trading_date(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return days.groupBy(*by).agg(F.max(_traded("SumClose")).alias("LastTradingDate"))


def with_range_bounds(anchors: DataFrame, ranges: Sequence[str] = RANGE_NAMES) -> DataFrame:
    """Every range for every row, with its first day; the list of ranges has a fixed length."""
    order = dict(TIME_RANGES)
    bounds = F.array(*(
        F.struct(F.lit(name).alias("RangeName"), F.lit(order[name]).alias("SortOrder"),
                 range_start(name, F.col("LastTradingDate")).alias("RangeStart"))
        for name in ranges))
    return anchors.select("*", F.inline(bounds))


def in_time_range(days: DataFrame, by: Sequence[str] = (), name: str = DEFAULT_RANGE) -> DataFrame:
    """Days inside one range of their group; any measure on the result is range-restricted."""
    return with_last_date(days, by).filter(_inside(name))


def expand_ranges(days: DataFrame, by: Sequence[str] = (),
                  ranges: Sequence[str] = RANGE_NAMES) -> DataFrame:
    """Each day once per range it falls in."""
    order = dict(TIME_RANGES)
    hits = F.array_compact(F.array(*(
        F.when(_inside(name),
               F.struct(F.lit(name).alias("RangeName"), F.lit(order[name]).alias("SortOrder")))
        for name in ranges)))
    return with_last_date(days, by).select("*", F.inline(hits))


def reaggregate(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Base measures from daily parts."""
    return days.groupBy(*by).agg(
        F.sum("SumClose").cast("double").alias("SumClose"),
        F.sum("SumOpen").cast("double").alias("SumOpen"),
        F.min("MinLow").cast("double").alias("MinLow"),
        F.max("MaxHigh").cast("double").alias("MaxHigh"),
        ratio(F.sum("SumVolume"), F.sum("CountVolume")).alias("AvgVolume"))


# -- first and last close -------------------------------------------------------------------

def range_endpoints(star: DataFrame, by: Sequence[str] = (),
                    ranges: Sequence[str] = RANGE_NAMES) -> DataFrame:
    """Per group and range: first and last trading date and the closes on them.

    All ranges are conditional aggregates of one pass over the days; they become rows only
    after the aggregation. The first value is the close of the first day, not its open.
    """
    days = with_last_date(daily(star, by), by)
    aggregates = [
        F.max("LastTradingDate").alias("LastTradingDate"),
        F.max_by("SumClose", _traded("SumClose")).alias("LastClose"),
    ]
    for i, name in enumerate(ranges):
        opened = F.when(_inside(name), _traded("SumOpen"))
        aggregates += [F.min(opened).alias(f"_date{i}"), F.min_by("SumClose", opened).alias(f"_close{i}")]
    wide = days.groupBy(*by).agg(*aggregates)
    order = dict(TIME_RANGES)
    rows = F.array(*(
        F.struct(F.lit(name).alias("RangeName"), F.lit(order[name]).alias("SortOrder"),
                 range_start(name, F.col("LastTradingDate")).alias("RangeStart"),
                 F.col(f"_date{i}").alias("FirstTradingDate"), F.col(f"_close{i}").alias("FirstClose"))
        for i, name in enumerate(ranges)))
    return wide.select(*by, "LastTradingDate", "LastClose", F.inline(rows))


def growth_by_range(star: DataFrame, by: Sequence[str] = (),
                    ranges: Sequence[str] = RANGE_NAMES) -> DataFrame:
    """Endpoints plus the growth between them; groups with several symbols grow as a price sum."""
    return range_endpoints(star, by, ranges).withColumn(
        "Growth", growth(F.col("LastClose"), F.col("FirstClose")))


def average_growth(star: DataFrame, by: Sequence[str], ranges: Sequence[str]) -> DataFrame:
    """Mean of the symbols' own growth, each anchored on its own last trading date.

    ``by`` holds attributes of a symbol, such as its industry.
    """
    each = growth_by_range(star, [*by, "Symbol"], ranges)
    return each.groupBy(*by, "RangeName", "SortOrder").agg(F.avg("Growth").alias("AvgGrowth"))


def with_endpoints(star: DataFrame, by: Sequence[str] = (), name: str = DEFAULT_RANGE) -> DataFrame:
    """Days of one range, each carrying the group's first and last close."""
    group = _group(by)
    days = with_last_date(daily(star, by), by)
    inside = _inside(name)
    opened = F.when(inside, _traded("SumOpen"))
    return (days
            .withColumn("FirstClose", F.min_by("SumClose", opened).over(group))
            .withColumn("LastClose", F.max_by("SumClose", _traded("SumClose")).over(group))
            .filter(inside))
