"""Inputs shared by the registered queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from candlelake.context import SILVER_SPEC, BatchContext, TableSpec
from candlelake.operators.audit import add_audit_columns
from candlelake.operators.dims import build_dim_symbol, calendar
from candlelake.operators.facts import build_fact_daily
from candlelake.plans import market
from candlelake.queries import ctes
from candlelake.schemas import empty_table
from candlelake.session import stored
from candlelake.sources.generated import date_spine

BATCH_1 = BatchContext(ctes.BATCH_1, datetime.fromisoformat(ctes.LOAD_1))
BATCH_2 = BatchContext(ctes.BATCH_2, datetime.fromisoformat(ctes.LOAD_2))
CUSTOMER_SPEC = TableSpec("Dim", ("c_custkey",), ("c_acctbal",))
TODAY = date(2024, 2, 1)
CREATED = datetime(2024, 1, 1)


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type prices have in reports."""
    return df.withColumns({field.name: F.col(field.name).cast("double")
                           for field in df.schema.fields if isinstance(field.dataType, DecimalType)})


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), digits) for name in columns})


def id_checks(id_column: str, above: int = 0) -> list[Column]:
    """What holds for ids whose values are free: unique, and above the ones given out before."""
    uses = F.count(F.lit(1)).over(Window.partitionBy(id_column))
    return [(uses == 1).alias("IdIsUnique"), (F.col(id_column) > above).alias("IdIsAbove")]


def stored_bars(spark: SparkSession, folder: str) -> DataFrame:
    return stored(market.bars(spark, folder), "bars")


def silver_of(bars: DataFrame) -> DataFrame:
    return add_audit_columns(bars, SILVER_SPEC, BATCH_1)


def silver_again(bars: DataFrame) -> DataFrame:
    """The corrected second delivery of the same bars."""
    return add_audit_columns(market.corrected_bars(bars), SILVER_SPEC, BATCH_2)


def customer_load(spark: SparkSession, folder: str) -> DataFrame:
    return add_audit_columns(market.first_customers(spark, folder), CUSTOMER_SPEC, BATCH_1)


def customer_reload(spark: SparkSession, folder: str) -> DataFrame:
    return add_audit_columns(market.second_customers(spark, folder), CUSTOMER_SPEC, BATCH_2)


def current(rows: DataFrame) -> DataFrame:
    return rows.withColumn("__CurrentFlag", F.lit(True))


def traded_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """Attributes of the symbols with a trade; suppliers collapse before any row is shuffled."""
    active = market.table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("s_suppkey")).distinct()
    suppliers = market.table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nations = suppliers.join(active, "s_suppkey").select("s_nationkey").distinct()
    return market.symbols(spark, folder).join(nations, "s_nationkey")


def dim_of(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Symbol dimension after a first load of rows with symbol attributes."""
    return build_dim_symbol(empty_table(rows.sparkSession, "dim_symbol"), current(rows), lookup, BATCH_1)


def dim_symbol(spark: SparkSession, folder: str) -> DataFrame:
    return dim_of(traded_symbols(spark, folder), market.lookup(spark, folder))


def fact_of(bars: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact table after a first load."""
    return build_fact_daily(empty_table(bars.sparkSession, "fact_daily"), current(bars), dim, BATCH_1)


def calendar_of(days: DataFrame, column: str = "Date") -> DataFrame:
    """Calendar from the first to the last day of a column."""
    bounds = days.agg(F.min(column).cast("date").alias("start_date"), F.max(column).cast("date").alias("end_date"))
    return calendar(date_spine(bounds))


def trade_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return calendar_of(market.table(spark, folder, "lineitem"), "l_shipdate")
