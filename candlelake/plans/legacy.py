"""The older two-table layout: stamped responses, a metadata table and a price table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from candlelake import schemas
from candlelake.operators import flatten, sinks
from candlelake.sources.responses import read_below

STAMPED = f"meta {schemas.VALUE_MAP}, values ARRAY<{schemas.VALUE_MAP}>, created_date TIMESTAMP, symbol STRING"


def save_by_symbol(responses: DataFrame, path: str) -> None:
    """Append each response to its symbol's folder."""
    sinks.append_by_symbol(responses, path)


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str, created: datetime) -> None:
    """Append everything below the bronze folder, stamped; running it twice stores it twice."""
    sinks.append_by(flatten.stamp_created(read_below(spark, bronze), created), silver)


def silver_to_gold(spark: SparkSession, silver: str, gold: str) -> None:
    """Replace the metadata table and append to the price table."""
    stamped = spark.read.schema(STAMPED).parquet(silver)
    sinks.overwrite_evolving(flatten.legacy_dim_stock(stamped), f"{gold}/dim_stock")
    sinks.append_by(flatten.legacy_fact_price(stamped), f"{gold}/fact_stock_price")
