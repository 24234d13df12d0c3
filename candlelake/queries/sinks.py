"""Sinks and table lifecycle; every table is read back after the write."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from candlelake import schemas
from candlelake.operators import conform, dims, flatten, merge, sinks
from candlelake.plans import market
from candlelake.queries.common import CREATED, as_doubles, dim_symbol, silver_of, stored, stored_bars
from candlelake.queries.ctes import with_ctes
from candlelake.queries.registry import query
from candlelake.session import scratch_path
from candlelake.sources import responses
from candlelake.sources.generated import date_spine


def size():
    return F.size("values").cast("bigint").alias("n_values")


@query("sink_partition_overwrite", with_ctes("""
    SELECT Symbol AS symbol, CAST(Date AS DATE) AS Date, CAST(Close AS DOUBLE) AS Close FROM corrected
    UNION ALL
    SELECT Symbol, Date, CAST(Close AS DOUBLE) FROM bars WHERE ExchangeName = 'EUROPE'"""))
def sink_partition_overwrite(spark, folder):
    path = scratch_path(spark, "overwrite")
    first = stored_bars(spark, folder)
    for batch in (first, market.corrected_bars(first)):
        rows = batch.select(F.col("Symbol").alias("symbol"), "Date", "Close")
        sinks.overwrite_partitions(rows, path)
    stored = spark.read.schema("Date DATE, Close DECIMAL(18,3), symbol STRING").parquet(path)
    return as_doubles(stored.select("symbol", "Date", "Close"))


@query("sink_append_by_symbol", with_ctes("SELECT Symbol AS symbol, n_values FROM accepted"))
def sink_append_by_symbol(spark, folder):
    path = scratch_path(spark, "by-symbol")
    sinks.append_by_symbol(responses.accept(market.responses(spark, folder)), path)
    return responses.read_below(spark, path).select(F.col("meta.symbol").alias("symbol"), size())


@query("sink_append_partitioned", with_ctes("""
    SELECT Symbol AS symbol, n_values, TIMESTAMP '2024-01-01 00:00:00' AS created_date FROM accepted"""))
def sink_append_partitioned(spark, folder):
    path = scratch_path(spark, "stamped")
    stamped = flatten.stamp_created(responses.accept(market.responses(spark, folder)), CREATED)
    sinks.append_by(stamped, path)
    ddl = f"meta {schemas.VALUE_MAP}, values ARRAY<{schemas.VALUE_MAP}>, created_date TIMESTAMP, symbol STRING"
    return spark.read.schema(ddl).parquet(path).select("symbol", size(), "created_date")


LEGACY_DIM = """
    Symbol AS symbol, '1day' AS interval, Currency AS currency, ExchangeTimeZone AS exchange_timezone,
    ExchangeName AS exchange, CASE WHEN ExchangeName <> 'ASIA' THEN 'X' || substr(ExchangeName, 1, 3) END AS mic_code,
    Type AS type"""


@query("sink_overwrite_evolve", with_ctes(f"""
    SELECT {LEGACY_DIM}, TIMESTAMP '2024-01-01 00:00:00' AS created_date FROM accepted"""))
def sink_overwrite_evolve(spark, folder):
    path = scratch_path(spark, "legacy-dim")
    stamped = flatten.stamp_created(responses.accept(market.responses(spark, folder)), CREATED)
    full = stored(flatten.legacy_dim_stock(stamped), "legacy")
    sinks.overwrite_evolving(full.drop("mic_code", "created_date"), path, partition_by="symbol")
    sinks.overwrite_evolving(full, path, partition_by="symbol")
    return sinks.read_evolving(spark, path)


@query("sink_append_evolve", with_ctes("""
    SELECT Symbol AS symbol, Date, CAST(Close AS DOUBLE) AS close, CAST(NULL AS VARCHAR) AS exchange FROM bars
    UNION ALL
    SELECT Symbol, Date, CAST(Close AS DOUBLE), ExchangeName FROM corrected"""))
def sink_append_evolve(spark, folder):
    path = scratch_path(spark, "legacy-fact")
    first = stored_bars(spark, folder)
    keep = [F.col("Symbol").alias("symbol"), "Date", F.col("Close").cast("double").alias("close")]
    sinks.append_evolving(first.select(*keep), path)
    sinks.append_evolving(market.corrected_bars(first).select(*keep, F.col("ExchangeName").alias("exchange")), path)
    return sinks.read_evolving(spark, path)


@query("table_create", with_ctes("""
    SELECT Symbol, Date, Volume, CAST(Close AS DOUBLE) AS Close, __CurrentFlag, __HashValue FROM silver1"""))
def table_create(spark, folder):
    name = f"silver_{uuid.uuid4().hex}"
    sinks.create_known_table(spark, name, scratch_path(spark, "table"), "silver", replace=True)
    rows = stored(conform.conform(silver_of(market.bars(spark, folder)), schemas.SILVER), "rows")
    rows.write.insertInto(name)
    sinks.create_known_table(spark, name, scratch_path(spark, "table"), "silver", replace=True)
    rows.write.insertInto(name)
    return as_doubles(spark.table(name).select("Symbol", "Date", "Volume", "Close", "__CurrentFlag", "__HashValue"))


@query("table_conform", with_ctes("""
    SELECT Symbol, Date, Volume, CAST(High AS DOUBLE) AS High, CAST(Low AS DOUBLE) AS Low,
           CAST(Close AS DOUBLE) AS Close, CAST(Open AS DOUBLE) AS Open, CAST(NULL AS BIGINT) AS DateNumber
    FROM typed"""))
def table_conform(spark, folder):
    flat = flatten.flatten_responses(responses.accept(market.responses(spark, folder))).dropDuplicates()
    ddl = ("RowID BIGINT, Symbol STRING, Date DATE, Volume BIGINT, High DECIMAL(18,3), Low DECIMAL(18,3), "
           "Close DECIMAL(18,3), Open DECIMAL(18,3), DateNumber BIGINT")
    return as_doubles(conform.conform(conform.convertible(flat, ddl), ddl, skip=("RowID",)))


@query("table_add_columns", with_ctes("""
    SELECT DISTINCT Symbol, ExchangeName, Currency, CAST(NULL AS INTEGER) AS Sort,
           CAST(NULL AS VARCHAR) AS Industry, CAST(NULL AS VARCHAR) AS Logo FROM bars"""))
def table_add_columns(spark, folder):
    old = market.bars(spark, folder).select("Symbol", "ExchangeName", "Currency").distinct()
    return conform.add_columns(old, "Sort INT, Industry STRING, Logo STRING")


@query("view_current_dim", with_ctes("""
    SELECT SymbolSID, Symbol, ExchangeName, Currency, Type, ExchangeTimeZone, Sort, Industry, Logo FROM dimsym"""))
def view_current_dim(spark, folder):
    sinks.publish_view(dims.current_dim(dim_symbol(spark, folder)), "vw_dim_symbol")
    return spark.table("vw_dim_symbol")


@query("upsert_insert_only", with_ctes("""
    SELECT Date, 'kept' AS origin FROM dates WHERE Date IN (SELECT Date FROM bars WHERE ExchangeName = 'EUROPE')
    UNION ALL
    SELECT Date, 'added' FROM dates WHERE Date NOT IN (SELECT Date FROM bars WHERE ExchangeName = 'EUROPE')"""))
def upsert_insert_only(spark, folder):
    all_bars = stored_bars(spark, folder)
    held = (all_bars.filter("ExchangeName = 'EUROPE'").select("Date").distinct()
            .withColumn("origin", F.lit("kept")))
    bounds = all_bars.agg(F.min("Date").alias("start_date"), F.max("Date").alias("end_date"))
    return merge.insert_only(held, date_spine(bounds).withColumn("origin", F.lit("added")), ["Date"])
