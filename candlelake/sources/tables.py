"""Reading stored tables, whole, incrementally, or for reporting."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.context import AUDIT_COLUMNS

PRICES = ("Open", "High", "Low", "Close")


def read_table(spark: SparkSession, ref: str) -> DataFrame:
    """Read by folder path, by catalog name, or by ``parquet.`path```."""
    if "`" in ref:
        return spark.table(ref)
    if "/" in ref:
        return spark.read.option("mergeSchema", "true").parquet(ref)
    return spark.table(ref)


def changed_since(df: DataFrame, column: str, as_of: date, days: int = 10) -> DataFrame:
    """Rows modified later than ``days`` before ``as_of``.

    The bound is a literal against the bare column, so it reaches the parquet scan.
    """
    bound = F.lit((as_of - timedelta(days=days)).isoformat())
    return df.filter(F.col(column) > bound.cast(df.schema[column].dataType))


def import_dim(dim: DataFrame) -> DataFrame:
    return dim.drop(*AUDIT_COLUMNS)


def import_fact(fact: DataFrame) -> DataFrame:
    """Fact as the report model holds it: change hash kept, prices as doubles, newest keys first."""
    technical = AUDIT_COLUMNS - {"__FactSCD1Hash"}
    doubles = {name: F.col(name).cast("double") for name in PRICES}
    return fact.drop(*technical).withColumns(doubles).orderBy(F.col("SymbolSID").desc())
