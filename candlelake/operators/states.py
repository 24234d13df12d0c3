"""Maintained sums: mergeable states of a group's months, from which range measures are answered.

A state holds what the days of one group and month add up to, the first and the last trading day, and the days
themselves (31 at most). A range takes whole months from their states and only opens the days of the months its
ends fall in, so a measure over years reads a few dozen rows a group and no facts. States of a month follow from
that month's facts alone: a load refreshes the months it changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.functions.dates import RANGE_NAMES, TIME_RANGES, in_range, range_start
from candlelake.functions.values import growth, ratio
from candlelake.operators.measures import _group, daily

SUM, PRICE = "DECIMAL(28,3)", "DECIMAL(18,3)"
DAY = {"Date": "DATE", "SumOpen": SUM, "SumClose": SUM, "MinLow": PRICE, "MaxHigh": PRICE,
       "SumVolume": "BIGINT", "CountVolume": "BIGINT"}
STATE = {**{name: kind for name, kind in DAY.items() if name != "Date"},
         "FirstOpen": "DATE", "FirstClose": SUM, "LastDate": "DATE", "LastClose": SUM,
         "Days": f"ARRAY<STRUCT<{', '.join(f'{name}: {kind}' for name, kind in DAY.items())}>>"}


def state_ddl(by: Sequence[str]) -> str:
    """Columns of a stored table of states, the month last."""
    return ", ".join([*(f"{name} STRING" for name in by), *(f"{name} {kind}" for name, kind in STATE.items()), "Month INT"])


def month_states(star: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One state per group and month of the star's days; days sum up before anything of a group meets."""
    days = daily(star.filter(F.col("Date").isNotNull()), by)
    days = days.withColumns({name: F.col(name).cast(kind) for name, kind in DAY.items()}) \
        .withColumn("Month", F.year("Date") * 100 + F.month("Date"))
    opened, closed = (F.when(F.col(name) > 0, F.col("Date")) for name in ("SumOpen", "SumClose"))
    made = days.groupBy(*by, "Month").agg(
        *(F.sum(name).alias(name) for name in ("SumOpen", "SumClose", "SumVolume", "CountVolume")),
        F.min("MinLow").alias("MinLow"), F.max("MaxHigh").alias("MaxHigh"),
        F.min(opened).alias("FirstOpen"), F.min_by("SumClose", opened).alias("FirstClose"),
        F.max(closed).alias("LastDate"), F.max_by("SumClose", closed).alias("LastClose"),
        F.sort_array(F.collect_list(F.struct(*DAY))).alias("Days"))
    return made.select(*by, *(F.col(name).cast(kind).alias(name) for name, kind in STATE.items()), "Month")


def _anchored(states: DataFrame, by: Sequence[str]) -> DataFrame:
    first = F.make_date(F.floor(F.col("Month") / 100).cast("int"), F.col("Month") % 100, F.lit(1))
    return states.withColumn("LastTradingDate", F.max("LastDate").over(_group(by))) \
        .withColumn("_first", first).withColumn("_last", F.last_day(first))


def _whole(name: str) -> Column:
    """Whether all days of the month are inside a range."""
    if name == "MAX":
        return F.lit(True)
    anchor = F.col("LastTradingDate")
    return F.coalesce((range_start(name, anchor) <= F.col("_first")) & (F.col("_last") <= anchor), F.lit(False))


def _touched(name: str) -> Column:
    if name == "MAX":
        return F.lit(True)
    anchor = F.col("LastTradingDate")
    return F.coalesce((range_start(name, anchor) <= F.col("_last")) & (F.col("_first") <= anchor), F.lit(False))


def _days_inside(name: str) -> Column:
    return F.filter("Days", lambda day: in_range(name, day["Date"], F.col("LastTradingDate")))


def growth_from_states(states: DataFrame, by: Sequence[str] = (), ranges: Sequence[str] = RANGE_NAMES) -> DataFrame:
    """The rows of :func:`candlelake.operators.measures.growth_by_range`, without a look at the facts."""
    rows, order = _anchored(states, by), dict(TIME_RANGES)
    aggregates = [F.max("LastTradingDate").alias("LastTradingDate"), F.max_by("LastClose", "LastDate").alias("LastClose")]
    for i, name in enumerate(ranges):
        opened = F.get(F.filter(_days_inside(name), lambda day: day["SumOpen"] > 0), F.lit(0))
        edge = F.when(_touched(name), opened)
        rows = rows.withColumns({
            f"_date{i}": F.when(_whole(name), F.col("FirstOpen")).otherwise(edge["Date"]),
            f"_close{i}": F.when(_whole(name), F.col("FirstClose")).otherwise(edge["SumClose"])})
        aggregates += [F.min(f"_date{i}").alias(f"_date{i}"), F.min_by(f"_close{i}", f"_date{i}").alias(f"_close{i}")]
    found = F.array(*(
        F.struct(F.lit(name).alias("RangeName"), F.lit(order[name]).alias("SortOrder"),
                 range_start(name, F.col("LastTradingDate")).alias("RangeStart"),
                 F.col(f"_date{i}").alias("FirstTradingDate"), F.col(f"_close{i}").alias("FirstClose"))
        for i, name in enumerate(ranges)))
    wide = rows.groupBy(*by).agg(*aggregates)
    return wide.select(*by, "LastTradingDate", "LastClose", F.inline(found)).withColumn(
        "Growth", growth(F.col("LastClose"), F.col("FirstClose")))


def sums_from_states(states: DataFrame, by: Sequence[str] = (), ranges: Sequence[str] = RANGE_NAMES) -> DataFrame:
    """Sums, extremes and mean volume per group and range: whole months by their state, outer ones by their days."""
    rows, order = _anchored(states, by), dict(TIME_RANGES)
    parts = ("SumOpen", "SumClose", "MinLow", "MaxHigh", "SumVolume", "CountVolume")
    state = F.array(F.struct(*parts))
    hits = F.array_compact(F.array(*(
        F.when(_touched(name), F.struct(
            F.lit(name).alias("RangeName"), F.lit(order[name]).alias("SortOrder"),
            F.when(_whole(name), state).otherwise(F.transform(
                _days_inside(name), lambda day: F.struct(*(day[part].alias(part) for part in parts)))).alias("parts")))
        for name in ranges)))
    pieces = rows.select(*by, F.inline(hits)).select(*by, "RangeName", "SortOrder", F.inline("parts"))
    return pieces.groupBy(*by, "RangeName", "SortOrder").agg(
        F.sum("SumClose").cast("double").alias("SumClose"), F.sum("SumOpen").cast("double").alias("SumOpen"),
        F.min("MinLow").cast("double").alias("MinLow"), F.max("MaxHigh").cast("double").alias("MaxHigh"),
        ratio(F.sum("SumVolume"), F.sum("CountVolume")).alias("AvgVolume"))
