"""Sources that need no stored input: seeds, calendar, request list, refresh stamp."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake import schemas
from candlelake.functions.dates import TIME_RANGES
from candlelake.operators.surrogate import positions

# Granularities a request may ask for.
INTERVALS = ("1min", "1h", "1day", "1week", "1month")

# Seeded symbol reference (sort, industry, symbol, logo).
SYMBOL_LOOKUP_ROWS = [
    (0, "No Industry", "VOO", "https://upload.wikimedia.org/wikipedia/commons/8/81/Vanguard.svg"),
    (1, "Tech", "AAPL", "https://upload.wikimedia.org/wikipedia/commons/f/fa/Apple_logo_black.svg"),
    (2, "Tech", "MSFT", "https://upload.wikimedia.org/wikipedia/commons/4/44/Microsoft_logo.svg"),
    (3, "Tech", "NVDA", "https://upload.wikimedia.org/wikipedia/commons/2/21/Nvidia_logo.svg"),
    (4, "Automotive", "TSLA", "https://upload.wikimedia.org/wikipedia/commons/b/bd/Tesla_Motors.svg"),
    (5, "Automotive", "TM", "https://upload.wikimedia.org/wikipedia/commons/7/78/Toyota_Logo.svg"),
    (6, "Automotive", "F", "https://upload.wikimedia.org/wikipedia/commons/3/3e/Ford_logo_flat.svg"),
    (7, "Finance", "JPM", "https://upload.wikimedia.org/wikipedia/commons/0/07/J_P_Morgan_Chase_Logo_2008_1.svg"),
    (8, "Finance", "GS", "https://upload.wikimedia.org/wikipedia/commons/6/61/Goldman_Sachs.svg"),
    (9, "Finance", "MS", "https://upload.wikimedia.org/wikipedia/commons/3/34/Morgan_Stanley_Logo_1.svg"),
]


def symbol_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SYMBOL_LOOKUP_ROWS, schemas.schema_of(schemas.SYMBOL_LOOKUP))


def time_ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TIME_RANGES), schemas.schema_of(schemas.TIME_RANGE))


def date_spine(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per day of ``[start, end]`` for each row of ``bounds``; no row where a bound is NULL."""
    days = F.sequence(F.col(start).cast("date"), F.col(end).cast("date"), F.expr("interval 1 day"))
    ordered = F.col(start) <= F.col(end)
    return bounds.filter(ordered).select(F.explode(days).alias("Date"))


def spine_between(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    bounds = spark.range(1).select(F.lit(str(start)).cast("date").alias("start_date"),
                                   F.lit(str(end)).cast("date").alias("end_date"))
    return date_spine(bounds)


def request_plan(symbols: DataFrame, today: date, interval: str = "1day",
                 batch_size: int = 5, days_back: int = 10) -> DataFrame:
    """Symbols in numbered batches, each with the window to ask for."""
    if interval not in INTERVALS:
        raise ValueError(f"no such interval: {interval!r}; known are {', '.join(INTERVALS)}")
    distinct = symbols.select("symbol").distinct()
    placed = positions(distinct, F.sha2(F.col("symbol"), 256), "position")
    return placed.select(
        (F.floor((F.col("position") - 1) / batch_size) + 1).cast("bigint").alias("batch_no"),
        "symbol",
        F.lit(interval).alias("interval"),
        F.lit(today - timedelta(days=days_back)).alias("start_date"),
        F.lit(today + timedelta(days=1)).alias("end_date"))


def refresh_stamp(instants: DataFrame, utc: Column | None = None, zone: str = "UTC") -> DataFrame:
    """Local wall time and UTC time of a refresh, both without a zone."""
    at = utc if utc is not None else F.current_timestamp()
    return instants.select(F.from_utc_timestamp(at, zone).alias("MdtDateTime"), at.alias("UtcDateTime"))
