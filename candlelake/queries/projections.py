"""Projections, filters, nested data."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlelake.context import SILVER_SPEC
from candlelake.operators import flatten
from candlelake.operators.audit import add_audit_columns
from candlelake.plans import market
from candlelake.queries.common import BATCH_1, BATCH_2, CREATED, as_doubles, customer_load, customer_reload, CUSTOMER_SPEC
from candlelake.operators.merge import scd_merge
from candlelake.queries.ctes import sha, with_ctes, SILVER_KEY
from candlelake.queries.registry import query
from candlelake.queries.sinks import LEGACY_DIM
from candlelake.sources import responses


def accepted(spark, folder):
    return responses.accept(market.responses(spark, folder))


@query("proj_map_get", with_ctes("""
    SELECT CASE WHEN has_meta THEN Symbol END AS by_item, CASE WHEN has_meta THEN Currency END AS by_path,
           CASE WHEN has_meta AND ExchangeName <> 'ASIA' THEN 'X' || substr(ExchangeName, 1, 3) END AS by_key,
           CAST(NULL AS VARCHAR) AS absent
    FROM landed"""))
def proj_map_get(spark, folder):
    return market.responses(spark, folder).select(
        F.col("meta").getItem("symbol").alias("by_item"),
        F.col("meta.currency").alias("by_path"),
        *flatten.map_columns("meta", {"by_key": "mic_code", "absent": "isin"}))


@query("proj_explode_values", with_ctes("SELECT Symbol AS symbol, Date AS day, Close AS close FROM flat"))
def proj_explode_values(spark, folder):
    rows = flatten.explode_values(accepted(spark, folder))
    return rows.select("symbol", *flatten.map_columns("values", {"day": "datetime", "close": "close"}))


@query("flatten_bronze", with_ctes("SELECT * FROM flat"))
def flatten_bronze(spark, folder):
    return flatten.flatten_responses(accepted(spark, folder))


LEGACY_FACT = """
    Symbol AS symbol, CAST(Date AS TIMESTAMP) AS datetime, CAST(Open AS DOUBLE) AS open, CAST(High AS DOUBLE) AS high,
    CAST(Low AS DOUBLE) AS low, CAST(Close AS DOUBLE) AS close, CAST(Volume AS BIGINT) AS volume"""


@query("proj_cast_ohlcv", with_ctes(f"SELECT {LEGACY_FACT} FROM flatset"))
def proj_cast_ohlcv(spark, folder):
    stamped = flatten.stamp_created(accepted(spark, folder), CREATED)
    return flatten.legacy_fact_price(stamped).drop("created_date").dropDuplicates()


@query("legacy_dim_stock", with_ctes(f"""
    SELECT {LEGACY_DIM}, TIMESTAMP '2024-01-01 00:00:00' AS created_date FROM accepted"""))
def legacy_dim_stock(spark, folder):
    return flatten.legacy_dim_stock(flatten.stamp_created(accepted(spark, folder), CREATED))


@query("legacy_fact_price", with_ctes(f"""
    SELECT {LEGACY_FACT}, TIMESTAMP '2024-01-01 00:00:00' AS created_date FROM flat"""))
def legacy_fact_price(spark, folder):
    return flatten.legacy_fact_price(flatten.stamp_created(accepted(spark, folder), CREATED))


@query("proj_stamp_constants", with_ctes("""
    SELECT Symbol, Date, CAST(Close AS DOUBLE) AS Close, true AS __CurrentFlag, 'batch-1' AS __CreatedBatchLogId,
           TIMESTAMP '2024-01-01 00:00:00' AS __CreateDateTime, CAST(NULL AS VARCHAR) AS __UpdatedBatchLogId
    FROM bars"""))
def proj_stamp_constants(spark, folder):
    stamped = add_audit_columns(market.bars(spark, folder), SILVER_SPEC, BATCH_1)
    return as_doubles(stamped.select("Symbol", "Date", "Close", "__CurrentFlag", "__CreatedBatchLogId",
                                     "__CreateDateTime", "__UpdatedBatchLogId"))


@query("filter_current", with_ctes("""
    SELECT c_custkey, c_mktsegment, CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM dim_merged WHERE __CurrentFlag"""))
def filter_current(spark, folder):
    merged = scd_merge(customer_load(spark, folder), customer_reload(spark, folder), CUSTOMER_SPEC, BATCH_2)
    return as_doubles(merged.filter("__CurrentFlag").select("c_custkey", "c_mktsegment", "c_acctbal"))


@query("filter_in_list", with_ctes("""
    SELECT Symbol, Date, CAST(Close AS DOUBLE) AS Close FROM bars WHERE ExchangeName IN ('ASIA', 'EUROPE')"""))
def filter_in_list(spark, folder):
    chosen = market.bars(spark, folder).filter(F.col("ExchangeName").isin("ASIA", "EUROPE"))
    return as_doubles(chosen.select("Symbol", "Date", "Close"))


@query("dedup_rows", with_ctes("SELECT * FROM flatset"))
def dedup_rows(spark, folder):
    return flatten.flatten_responses(accepted(spark, folder)).dropDuplicates()


@query("pipe_transform", with_ctes(f"""
    SELECT Symbol, ExchangeName, Date, CAST(Close AS DOUBLE) AS Close, {sha(*SILVER_KEY)} AS __HashKey FROM typed"""))
def pipe_transform(spark, folder):
    return (market.responses(spark, folder)
            .transform(responses.accept)
            .transform(flatten.flatten_responses)
            .transform(lambda df: df.dropDuplicates())
            .transform(add_audit_columns, SILVER_SPEC, BATCH_1)
            .select("Symbol", "ExchangeName", F.col("Date").cast("date").alias("Date"),
                    F.col("Close").cast("double").alias("Close"), "__HashKey"))
