"""Ranges that stand in a table: days joined with intervals of any start and end.

A comparison of two bounds gives the planner nothing to hash. Days therefore carry a bin of the calendar, an
interval stands once in every bin it touches, and the two meet by bin: a shuffled or broadcast hash join as
size and statistics say. A day has one bin, so no pair meets twice, and only the two outer bins of an interval
hold days that the comparison still has to turn away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.functions.values import growth
from candlelake.operators.measures import daily

BIN_DAYS = 64
#: Columns of a parameter table; bounds are days, both included, and a null bound is open.
RANGE_COLUMNS = ("RangeName", "StartDate", "EndDate")


def _bin(day: Column, width: int) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / width).cast("bigint")


def days_in_ranges(days: DataFrame, ranges: DataFrame, date: str = "Date", bin_days: int = BIN_DAYS) -> DataFrame:
    """Every day row with every range that holds its date.

    ``ranges`` has ``RANGE_COLUMNS`` and any others, none named like a column of ``days``; ranges may overlap,
    repeat, be empty (an end before the start) or have a null bound, which is open. Rows without a date are in
    no range. An interval is cut to the dates there are before it is dealt to its bins, so it has at most as
    many as the calendar of the data. ``days`` is read twice: pass a stored table or a cheap plan.
    """
    span = days.agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    first, last = span.select("_first").scalar(), span.select("_last").scalar()
    cut = ranges.withColumn("_from", F.greatest(F.coalesce("StartDate", first), first)) \
        .withColumn("_to", F.least(F.coalesce("EndDate", last), last)).filter("_from <= _to")
    dealt = cut.withColumn("_bin", F.explode(F.sequence(
        _bin(F.col("_from"), bin_days), _bin(F.col("_to"), bin_days))))
    binned = days.withColumn("_bin", _bin(F.col(date), bin_days))
    return binned.join(dealt, "_bin").filter(F.col(date).between(F.col("_from"), F.col("_to"))) \
        .drop("_bin", "_from", "_to")


def measures_in_ranges(star: DataFrame, ranges: DataFrame, by: Sequence[str] = (),
                       bin_days: int = BIN_DAYS) -> DataFrame:
    """Closes at both ends, growth, extremes and volume per group and range of a table.

    As for the fixed ranges the first day is the first with a positive opening sum, the last the last with a
    positive closing sum, both inside the range; a group without days in a range has no row.
    """
    pairs = days_in_ranges(daily(star, by), ranges.select(*RANGE_COLUMNS), bin_days=bin_days)
    opened = F.when(F.col("SumOpen") > 0, F.col("Date"))
    closed = F.when(F.col("SumClose") > 0, F.col("Date"))
    found = pairs.groupBy(*by, *RANGE_COLUMNS).agg(
        F.min(opened).alias("FirstTradingDate"), F.max(closed).alias("LastTradingDate"),
        F.min_by("SumClose", opened).alias("FirstClose"), F.max_by("SumClose", closed).alias("LastClose"),
        F.min("MinLow").alias("MinLow"), F.max("MaxHigh").alias("MaxHigh"), F.sum("SumVolume").alias("SumVolume"),
        F.count(F.lit(1)).alias("Days"))
    return found.withColumn("Growth", growth(F.col("LastClose"), F.col("FirstClose")))


def chosen_ranges(ranges: DataFrame, chosen: DataFrame, default: str) -> DataFrame:
    """The ranges a slicer leaves: those chosen by name, or the default one where nothing known is chosen."""
    names = chosen.select("RangeName").distinct()
    kept = ranges.join(names, "RangeName", "left_semi")
    none = F.coalesce(kept.agg(F.count(F.lit(1))).scalar(), F.lit(0)) == 0
    return kept.unionByName(ranges.filter((F.col("RangeName") == default) & none))
