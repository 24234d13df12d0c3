"""Report queries: one grouped query per shape, whatever the number of visuals it feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.functions.dates import DEFAULT_RANGE
from candlelake.functions.values import growth_text, investment_growth, is_up, ratio, trend_color
from candlelake.operators.measures import (
    growth_by_range, measure, selected_value, with_endpoints)

CARD_RANGES = ("30 Days", "90 Days", "1Y", "5Y")
PIVOT_RANGES = {"Growth90": "90 Days", "Growth1Y": "1Y", "Growth5Y": "5Y"}


def up() -> Column:
    return is_up(F.col("LastClose"), F.col("FirstClose"))


def trend_split(series: DataFrame) -> DataFrame:
    """The close of a day in the green column of a rising series or the red of a falling one."""
    close = F.col("SumClose").cast("double")
    return series.withColumns({"Green": F.when(up(), close), "Red": F.when(~up(), close)})


def series_report(star: DataFrame, by: Sequence[str] = (), name: str = DEFAULT_RANGE) -> DataFrame:
    """Area chart: split close plus tooltip measures per day."""
    return trend_split(with_endpoints(star, by, name)).select(
        *by, "Date", "Green", "Red",
        F.col("SumOpen").cast("double").alias("SumOpen"),
        F.col("MinLow").cast("double").alias("MinLow"),
        F.col("MaxHigh").cast("double").alias("MaxHigh"),
        ratio(F.col("SumVolume"), F.col("CountVolume")).alias("AvgVolume"))


def month_report(star: DataFrame, by: Sequence[str] = (), name: str = DEFAULT_RANGE) -> DataFrame:
    """The same chart drilled up to months: closes of the month's days in the range are summed."""
    month = F.make_date(F.year("Date"), F.month("Date"), F.lit(1))
    days = with_endpoints(star, by, name).withColumn("YearMonthDate", month)
    rolled = days.groupBy(*by, "YearMonthDate").agg(
        *(F.sum(part).alias(part) for part in ("SumClose", "SumOpen", "SumVolume", "CountVolume")),
        F.min("MinLow").alias("MinLow"), F.max("MaxHigh").alias("MaxHigh"),
        F.max("FirstClose").alias("FirstClose"), F.max("LastClose").alias("LastClose"))
    return trend_split(rolled).select(
        *by, "YearMonthDate", "Green", "Red",
        F.col("SumOpen").cast("double").alias("SumOpen"),
        F.col("MinLow").cast("double").alias("MinLow"),
        F.col("MaxHigh").cast("double").alias("MaxHigh"),
        ratio(F.col("SumVolume"), F.col("CountVolume")).alias("AvgVolume"))


def sparklines(star: DataFrame, name: str = DEFAULT_RANGE) -> DataFrame:
    """Split close per symbol and day, with the first close as reference line."""
    return trend_split(with_endpoints(star, ["Symbol"], name)).select(
        "Symbol", "Date", "Green", "Red", F.col("FirstClose").cast("double").alias("ReferenceLine"))


def _text_and_color(growths: DataFrame) -> DataFrame:
    return growths.withColumns({
        "GrowthText": growth_text(F.col("Growth")),
        "Color": trend_color(F.col("LastClose"), F.col("FirstClose"))})


def symbol_cards(star: DataFrame, name: str = DEFAULT_RANGE) -> DataFrame:
    """Last close, growth text and colour of every symbol."""
    return _text_and_color(growth_by_range(star, ["Symbol"], [name])).select(
        "Symbol", F.col("LastClose").cast("double").alias("LastClose"), "GrowthText", "Color")


def range_cards(star: DataFrame, ranges: Sequence[str] = CARD_RANGES) -> DataFrame:
    """Growth text and worth of the investment per symbol and range."""
    return _text_and_color(growth_by_range(star, ["Symbol"], ranges)).select(
        "Symbol", "RangeName", "GrowthText", investment_growth(F.col("Growth")).alias("Investment"))


def selection_cards(star: DataFrame, by: Sequence[str], name: str, refreshed: DataFrame) -> DataFrame:
    """Every card of a slicer selection in one row per selectable member."""
    return _text_and_color(growth_by_range(star, by, [name])).select(
        *by, "RangeName",
        F.col("FirstClose").cast("double").alias("FirstClose"),
        F.col("LastClose").cast("double").alias("LastClose"),
        "FirstTradingDate", "LastTradingDate", "GrowthText",
        refreshed.agg(F.max("UtcDateTime")).scalar().alias("Refreshed"))


def industry_pivot(star: DataFrame) -> DataFrame:
    """Symbols by industry with growth per range, an Average row closing each industry."""
    ranges = {column: F.max(F.when(F.col("RangeName") == name, F.col("Growth"))).alias(column)
              for column, name in PIVOT_RANGES.items()}
    rows = (growth_by_range(star, ["Industry", "Symbol"], list(PIVOT_RANGES.values()))
            .groupBy("Industry", "Symbol").agg(*ranges.values()))
    totals = with_average_rows(rows, ["Industry"], list(PIVOT_RANGES))
    return totals.orderBy("Industry", "IsTotal", F.col("Growth5Y").desc_nulls_last(), "Symbol")


def with_average_rows(rows: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Detail rows per symbol plus one "Average" row per group."""
    keys = [F.col(name) for name in by]
    grouped = rows.groupingSets([[*keys, F.col("Symbol")], keys], *keys, F.col("Symbol"))
    return grouped.agg(
        F.grouping("Symbol").cast("int").alias("IsTotal"),
        *(F.avg(value).alias(value) for value in values)
    ).withColumn("Symbol", F.when(F.col("IsTotal") == 1, F.lit("Average")).otherwise(F.col("Symbol")))


def summarize_series(star: DataFrame, required: str = "SumOpen",
                     measures: Sequence[str] = ("SumOpen", "MinLow", "MaxHigh", "AvgVolume"),
                     by: Sequence[str] = ("Date",)) -> DataFrame:
    """Measures per day; a day stays only if the required measure is not blank."""
    return measure(star, measures, by).filter(F.col(required).isNotNull()).orderBy(*by)


def slicer_values(dim: DataFrame, default: str) -> DataFrame:
    """Selectable symbols in display order, the preselected one marked."""
    members = dim.select("Symbol", "Sort", "Logo").distinct()
    return (members.withColumn("IsDefault", F.col("Symbol") == F.lit(default))
            .orderBy("Sort", "Symbol"))


def range_slicer(ranges: DataFrame, default: str = DEFAULT_RANGE) -> DataFrame:
    return ranges.withColumn("IsDefault", F.col("RangeName") == F.lit(default)).orderBy("SortOrder")


def selected_range(selection: DataFrame) -> DataFrame:
    """The one selected range, else the default."""
    return selected_value(selection, "RangeName", default=DEFAULT_RANGE, name="SelectedRange")
