"""Calendar and symbol dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlelake.context import DIM_SYMBOL_SPEC, BatchContext, TableSpec
from candlelake.functions.dates import date_id
from candlelake.operators.audit import add_audit_columns
from candlelake.operators.merge import insert_only, scd_merge
from candlelake.sources.generated import date_spine, spine_between

# Fixed value: first day of a calendar built from nothing.
CALENDAR_START = "2000-01-01"

SYMBOL_COLUMNS = ("Symbol", "ExchangeName", "Currency", "Type", "ExchangeTimeZone")


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes for a column of days."""
    day = F.col("Date")
    return days.select(
        date_id(day).alias("DateID"),
        day,
        F.dayofmonth(day).alias("Day"),
        F.date_format(day, "EEEE").alias("DayOfWeek"),
        F.dayofweek(day).alias("DayOfWeekNumber"),
        F.date_format(day, "MMM").alias("MonthName"),
        F.month(day).alias("MonthNumber"),
        F.year(day).alias("Year"),
        (F.year(day) * 100 + F.month(day)).alias("YearMonth"))


def missing_days(dim: DataFrame, facts: DataFrame) -> DataFrame:
    """Days the calendar lacks to hold whole years around the data.

    An empty dimension starts at the calendar's origin, or earlier with the first data year. A filled
    one grows at the end that the data exceeds; without data nothing is missing.
    """
    none = F.lit(None).cast("date")
    first, last = F.min("Date"), F.max("Date")
    spans = (dim.agg(first.alias("_first"), last.alias("_last"), none.alias("_from"), none.alias("_to"))
             .unionByName(facts.agg(none.alias("_first"), none.alias("_last"), first.alias("_from"), last.alias("_to")))
             .agg(*(F.max(name).alias(name) for name in ("_first", "_last", "_from", "_to"))))
    new_year, year_end = F.trunc("_from", "year"), F.make_date(F.year("_to"), F.lit(12), F.lit(31))
    empty, origin = F.col("_first").isNull(), F.lit(CALENDAR_START).cast("date")

    def span(when: Column, start: Column, end: Column) -> Column:
        return F.when(when, F.struct(start.alias("start_date"), end.alias("end_date")))

    bounds = F.array_compact(F.array(
        span(empty & F.col("_from").isNotNull(), F.least(origin, new_year), year_end),
        span(F.col("_from") < F.col("_first"), new_year, F.date_sub("_first", 1)),
        span(F.col("_to") > F.col("_last"), F.date_add("_last", 1), year_end)))
    return date_spine(spans.select(F.inline(bounds)))


def extend_calendar(dim: DataFrame, facts: DataFrame) -> DataFrame:
    return insert_only(dim, calendar(missing_days(dim, facts)), ["Date"])


def update_calendar(spark: SparkSession, path: str, start: date | str = CALENDAR_START,
                    end: date | str = "2010-12-31") -> None:
    """Add the days of a range to a stored calendar, creating it on first use."""
    days = calendar(spine_between(spark, start, end))
    try:
        held = spark.read.parquet(path).select("Date")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        days = days.join(held, "Date", "left_anti").select(*days.columns)
    days.write.mode("append").parquet(path)


def with_first_of_month(dim: DataFrame) -> DataFrame:
    return dim.withColumn("YearMonthDate", F.make_date("Year", "MonthNumber", F.lit(1)))


def open_dates(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """The calendar if the grand total of opening prices is positive, else nothing."""
    return dim.filter(fact.agg(F.sum("Open")).scalar() > 0)


def symbol_candidates(silver: DataFrame, lookup: DataFrame, strict: bool = False) -> DataFrame:
    """Symbol attributes enriched from the lookup; unknown symbols drop out.

    A key has one candidate, its newest attributes by day and load among the current rows. Attributes
    are collapsed with fixed-width buffers first. Strict mode takes all versions.
    """
    if strict:
        return silver.select(*SYMBOL_COLUMNS).distinct().join(lookup, "Symbol")
    dated = [name for name in ("Date", "__lastmodified") if name in silver.columns]
    seen = silver.filter("__CurrentFlag").groupBy(*SYMBOL_COLUMNS).agg(
        F.count(F.lit(1)).alias("_n"), *(F.max(name).alias(f"_{name}") for name in dated))
    if dated:
        newest = Window.partitionBy(*DIM_SYMBOL_SPEC.business_columns).orderBy(
            *(F.desc(f"_{name}") for name in dated), "Type", "ExchangeTimeZone")
        seen = seen.withColumn("_n", F.row_number().over(newest)).filter("_n = 1")
    return seen.select(*SYMBOL_COLUMNS).join(lookup, "Symbol")


def build_dim_symbol(target: DataFrame, silver: DataFrame, lookup: DataFrame, batch: BatchContext,
                     spec: TableSpec = DIM_SYMBOL_SPEC) -> DataFrame:
    source = add_audit_columns(symbol_candidates(silver, lookup, spec.strict), spec, batch)
    return scd_merge(target, source, spec, batch, id_column="SymbolSID")


def current_dim(dim: DataFrame) -> DataFrame:
    """Open, undeleted versions with business columns only."""
    return (dim.filter(F.col("__CurrentFlag") & ~F.col("__DeletedFlag"))
            .select("SymbolSID", *SYMBOL_COLUMNS, "Sort", "Industry", "Logo"))


def member_dim(dim: DataFrame) -> DataFrame:
    """The id of every version with the attributes its symbol has now: facts keep the id they were loaded with."""
    key = DIM_SYMBOL_SPEC.key_hash
    now = dim.filter(F.col("__CurrentFlag") & ~F.col("__DeletedFlag")) \
        .select(key, *SYMBOL_COLUMNS, "Sort", "Industry", "Logo")
    return dim.select("SymbolSID", key).join(now, key, "left").drop(key)
