"""Nested responses to flat rows, in the current and the older layout."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Flat column -> key in the response metadata / in one daily value.
META_KEYS = {
    "Symbol": "symbol",
    "ExchangeName": "exchange",
    "Currency": "currency",
    "Type": "type",
    "ExchangeTimeZone": "exchange_timezone",
}
VALUE_KEYS = {
    "Volume": "volume",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Open": "open",
    "Date": "datetime",
}
LEGACY_META = ("symbol", "interval", "currency", "exchange_timezone", "exchange", "mic_code", "type")


def map_columns(map_column: str, keys: dict[str, str]) -> list[Column]:
    """Map entries as columns; a missing key gives NULL."""
    return [F.try_element_at(F.col(map_column), F.lit(key)).alias(name) for name, key in keys.items()]


def explode_values(responses: DataFrame) -> DataFrame:
    """One row per daily value; a response without values disappears."""
    return responses.withColumn("values", F.explode("values"))


def flatten_responses(responses: DataFrame) -> DataFrame:
    """Eleven flat text columns per daily value."""
    return explode_values(responses).select(*map_columns("meta", META_KEYS), *map_columns("values", VALUE_KEYS))


def stamp_created(responses: DataFrame, created: datetime) -> DataFrame:
    """Older layout: creation stamp plus the symbol lifted from the metadata."""
    return (responses.withColumn("created_date", F.lit(created))
            .withColumn("symbol", F.col("meta.symbol")))


def legacy_dim_stock(stamped: DataFrame) -> DataFrame:
    """Metadata of every response; one row each, not deduplicated."""
    return stamped.select(*(F.col(f"meta.{key}").alias(key) for key in LEGACY_META), "created_date")


def legacy_fact_price(stamped: DataFrame) -> DataFrame:
    """Typed daily values; text that is no number becomes NULL."""
    value = stamped.select("symbol", "created_date", F.explode("values").alias("value"))
    return value.select(
        "symbol",
        F.col("value.datetime").try_cast("timestamp").alias("datetime"),
        *(F.col(f"value.{key}").try_cast("double").alias(key) for key in ("open", "high", "low", "close")),
        F.col("value.volume").try_cast("bigint").alias("volume"),
        "created_date")
