"""Declared schemas of every table, as DDL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

VALUE_MAP = "MAP<STRING, STRING>"
RESPONSE = f"meta {VALUE_MAP}, values ARRAY<{VALUE_MAP}>, status STRING"
# Spark's name for the text of a document that is no JSON of the declared schema.
BROKEN = "_corrupt_record"
LANDED = f"{RESPONSE}, {BROKEN} STRING"
BRONZE = f"meta {VALUE_MAP}, values ARRAY<{VALUE_MAP}>, symbol STRING"

_VERSION_FLAGS = """
    __CurrentFlag BOOLEAN, __DeletedFlag BOOLEAN,
    __EffectiveStartDateTime TIMESTAMP, __EffectiveEndDateTime TIMESTAMP"""
_BATCH = """
    __CreatedBatchLogId STRING, __UpdatedBatchLogId STRING,
    __CreateDateTime TIMESTAMP, __UpdateDateTime TIMESTAMP"""
_PRICES = "High DECIMAL(18,3), Low DECIMAL(18,3), Close DECIMAL(18,3), Open DECIMAL(18,3)"

SILVER = f"""
    Symbol STRING, ExchangeName STRING, Currency STRING, Type STRING, ExchangeTimeZone STRING,
    Volume BIGINT, {_PRICES}, Date DATE, {_VERSION_FLAGS}, __lastmodified TIMESTAMP,
    __HashKey STRING, __HashValue STRING, {_BATCH}"""

DIM_SYMBOL = f"""
    SymbolSID BIGINT, Symbol STRING, ExchangeName STRING, Currency STRING, Type STRING,
    ExchangeTimeZone STRING, Sort INT, Industry STRING, Logo STRING, {_VERSION_FLAGS},
    __BusinessKeyHash STRING, __Hash1Type STRING, __Hash2Type STRING, {_BATCH}"""

DIM_DATE = """
    DateID INT, Date DATE, Day INT, DayOfWeek STRING, DayOfWeekNumber INT,
    MonthName STRING, MonthNumber INT, Year INT, YearMonth INT"""

FACT_DAILY = f"""
    TransactionSID BIGINT, SymbolSID BIGINT, Volume BIGINT, {_PRICES}, DateID INT,
    __DeletedFlag BOOLEAN, __FactKeyHash STRING, __FactSCD1Hash STRING,
    __CreatedBatchLogId STRING, __CreateDateTime TIMESTAMP"""

SYMBOL_LOOKUP = "Sort INT, Industry STRING, Symbol STRING, Logo STRING"
TIME_RANGE = "RangeName STRING, SortOrder INT"

# One line per finished step of a delivery; ``Path`` is what the step wrote. The last step is its retirement.
JOURNAL = "Delivery BIGINT, BatchId STRING, Start TIMESTAMP, Step STRING, Path STRING"

TABLES = {
    "silver": SILVER,
    "dim_symbol": DIM_SYMBOL,
    "dim_date": DIM_DATE,
    "fact_daily": FACT_DAILY,
    "symbol_lookup": SYMBOL_LOOKUP,
}


def schema_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def empty_of(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows under a schema, written so that the optimizer sees it: joins with it vanish."""
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    return spark.range(1).select(*nulls).filter(F.lit(False))


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return empty_of(spark, schema_of(TABLES[name]))
