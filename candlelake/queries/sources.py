"""Scans and sources."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake import schemas
from candlelake.operators import sinks
from candlelake.plans import market
from candlelake.queries.common import (
    TODAY, as_doubles, dim_of, dim_symbol, fact_of, id_checks, silver_of, stored, stored_bars, trade_calendar)
from candlelake.queries.ctes import with_ctes
from candlelake.queries.registry import query
from candlelake.session import scratch_path
from candlelake.sources import generated, responses, tables


@query("src_request_plan", f"""
    SELECT CAST(floor((row_number() OVER (ORDER BY sha256(s_name)) - 1) / 5) + 1 AS BIGINT) AS batch_no,
           s_name AS symbol, '1day' AS interval, DATE '{TODAY}' - 10 AS start_date, DATE '{TODAY}' + 1 AS end_date
    FROM (SELECT DISTINCT s_name FROM supplier)""")
def src_request_plan(spark, folder):
    symbols = market.table(spark, folder, "supplier").select(F.col("s_name").alias("symbol"))
    return generated.request_plan(symbols, TODAY)


def landed(spark, folder):
    """Responses written as JSON documents and read back under the declared schema.

    A broken document of every nation landed among them, and an indented one of every region beside them.
    """
    path, indented = scratch_path(spark, "landed"), scratch_path(spark, "landed-indented")
    market.responses(spark, folder).write.json(path)
    name = market.table(spark, folder, "nation").select(F.concat(F.lit('{"meta": {"symbol": "'), "n_name").alias("value"))
    name.write.mode("append").text(path)
    body = F.format_string('{\n "meta": {\n  "symbol": "%s"},\n "values": [],\n "status": "ok"}', F.col("r_name"))
    regions = market.table(spark, folder, "region")
    regions.select(body.alias("value"), "r_name").write.partitionBy("r_name").text(indented)
    whole = responses.read_landed(spark, indented, multi_line=True)
    return responses.read_landed(spark, path).unionByName(whole.select(*schemas.schema_of(schemas.LANDED).names))


def bronze_path(spark, folder):
    path = scratch_path(spark, "bronze")
    sinks.overwrite_partitions(responses.accept(market.responses(spark, folder)), path)
    return path


def overview(df, *columns):
    return df.select(
        F.col("meta.symbol").alias("symbol"), F.col("meta.mic_code").alias("mic_code"),
        F.size("values").cast("bigint").alias("n_values"), *columns)


DOC_COLUMNS = """
    CASE WHEN has_meta THEN Symbol END AS symbol,
    CASE WHEN has_meta AND ExchangeName <> 'ASIA' THEN 'X' || substr(ExchangeName, 1, 3) END AS mic_code"""


@query("src_landed_responses", with_ctes(f"""
    SELECT {DOC_COLUMNS}, status, n_values, CAST(NULL AS VARCHAR) AS broken FROM landed
    UNION ALL SELECT NULL, NULL, NULL, NULL, '{{"meta": {{"symbol": "' || n_name FROM nation
    UNION ALL SELECT r_name, NULL, 'ok', 0, NULL FROM region"""))
def src_landed_responses(spark, folder):
    return overview(landed(spark, folder), "status", F.col(schemas.BROKEN).alias("broken"))


@query("src_accept_responses", with_ctes(f"""
    SELECT {DOC_COLUMNS}, n_values, has_meta AND status = 'ok' AS accepted FROM landed"""))
def src_accept_responses(spark, folder):
    docs = market.responses(spark, folder)
    return overview(docs.withColumn("accepted", responses.is_accepted()), "accepted")


@query("src_bronze_parquet", with_ctes("SELECT Symbol AS symbol, n_values FROM accepted"))
def src_bronze_parquet(spark, folder):
    bronze = responses.read_bronze(spark, bronze_path(spark, folder))
    return bronze.select(F.col("meta.symbol").alias("symbol"), F.size("values").cast("bigint").alias("n_values"))


@query("src_recursive_parquet", with_ctes("SELECT Symbol AS symbol, n_values FROM accepted"))
def src_recursive_parquet(spark, folder):
    below = responses.read_below(spark, bronze_path(spark, folder))
    return below.select(F.col("meta.symbol").alias("symbol"), F.size("values").cast("bigint").alias("n_values"))


@query("src_versioned_table", with_ctes("""
    SELECT form, Symbol, Date, CAST(Close AS DOUBLE) AS Close, __CurrentFlag, __HashKey
    FROM silver1, (VALUES ('path'), ('quoted path'), ('name')) AS forms(form)"""))
def src_versioned_table(spark, folder):
    path, name = scratch_path(spark, "silver"), f"silver_{uuid.uuid4().hex}"
    rows = silver_of(market.bars(spark, folder))
    rows.write.parquet(path)
    sinks.create_table(spark, name, rows.schema.toDDL(), path)
    refs = {"path": path, "quoted path": f"parquet.`{path}`", "name": name}
    read = [tables.read_table(spark, ref).select(F.lit(form).alias("form"), "Symbol", "Date", "Close", "__CurrentFlag", "__HashKey")
            for form, ref in refs.items()]
    return as_doubles(reduce(DataFrame.unionByName, read))


@query("src_changed_since", """
    SELECT event_id, ts, user_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAY""")
def src_changed_since(spark, folder):
    events = market.table(spark, folder, "events")
    recent = tables.changed_since(events, "ts", datetime(2024, 1, 31), days=10)
    return recent.select("event_id", "ts", "user_id", "event_type")


@query("src_date_spine", with_ctes("SELECT Date FROM dates"))
def src_date_spine(spark, folder):
    bounds = market.table(spark, folder, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("start_date"), F.max("l_shipdate").cast("date").alias("end_date"))
    return generated.date_spine(bounds)


@query("src_seed_rows", with_ctes("SELECT * FROM lookup"))
def src_seed_rows(spark, folder):
    return market.lookup(spark, folder)


@query("src_refresh_stamp", """
    SELECT max(ts) - INTERVAL 6 HOUR AS MdtDateTime, max(ts) AS UtcDateTime FROM events""")
def src_refresh_stamp(spark, folder):
    newest = market.table(spark, folder, "events").agg(F.max("ts").cast("timestamp").alias("at"))
    return generated.refresh_stamp(newest, F.col("at"), "-06:00")


@query("src_model_import", with_ctes("""
    SELECT true AS IdIsUnique, true AS IdIsAbove, coalesce(SymbolSID, -1) AS SymbolSID,
           Volume, CAST(High AS DOUBLE) AS High, CAST(Low AS DOUBLE) AS Low, CAST(Close AS DOUBLE) AS Close,
           CAST(Open AS DOUBLE) AS Open, DateID, __FactSCD1Hash
    FROM fact1"""))
def src_model_import(spark, folder):
    rows = stored_bars(spark, folder)
    imported = tables.import_fact(stored(fact_of(rows, dim_of(rows, market.lookup(spark, folder))), "fact"))
    return imported.select("*", *id_checks("TransactionSID")).drop("TransactionSID").withColumn(
        "SymbolSID", F.coalesce("SymbolSID", F.lit(-1).cast("bigint")))


@query("src_model_import_dim", with_ctes("""
    SELECT SymbolSID, Symbol, ExchangeName, Currency, Type, ExchangeTimeZone, Sort, Industry, Logo FROM dimsym"""))
def src_model_import_dim(spark, folder):
    return tables.import_dim(dim_symbol(spark, folder))


@query("src_model_import_date", with_ctes("SELECT * FROM cal"))
def src_model_import_date(spark, folder):
    path = scratch_path(spark, "dim-date")
    trade_calendar(spark, folder).write.parquet(path)
    return tables.import_dim(tables.read_table(spark, path))


# The seeded rows, written out so that the check does not lean on the table it checks.
SEEDS_SQL = """
    (0, 'No Industry', 'VOO', 'https://upload.wikimedia.org/wikipedia/commons/8/81/Vanguard.svg'),
    (1, 'Tech', 'AAPL', 'https://upload.wikimedia.org/wikipedia/commons/f/fa/Apple_logo_black.svg'),
    (2, 'Tech', 'MSFT', 'https://upload.wikimedia.org/wikipedia/commons/4/44/Microsoft_logo.svg'),
    (3, 'Tech', 'NVDA', 'https://upload.wikimedia.org/wikipedia/commons/2/21/Nvidia_logo.svg'),
    (4, 'Automotive', 'TSLA', 'https://upload.wikimedia.org/wikipedia/commons/b/bd/Tesla_Motors.svg'),
    (5, 'Automotive', 'TM', 'https://upload.wikimedia.org/wikipedia/commons/7/78/Toyota_Logo.svg'),
    (6, 'Automotive', 'F', 'https://upload.wikimedia.org/wikipedia/commons/3/3e/Ford_logo_flat.svg'),
    (7, 'Finance', 'JPM', 'https://upload.wikimedia.org/wikipedia/commons/0/07/J_P_Morgan_Chase_Logo_2008_1.svg'),
    (8, 'Finance', 'GS', 'https://upload.wikimedia.org/wikipedia/commons/6/61/Goldman_Sachs.svg'),
    (9, 'Finance', 'MS', 'https://upload.wikimedia.org/wikipedia/commons/3/34/Morgan_Stanley_Logo_1.svg')"""


@query("src_seed_symbols", f"""
    SELECT Sort, Industry, Symbol, Logo, n_name AS Nation
    FROM (VALUES {SEEDS_SQL}) AS seeds(Sort, Industry, Symbol, Logo) JOIN nation ON n_nationkey = Sort""")
def src_seed_symbols(spark, folder):
    nations = market.table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("int").alias("Sort"), F.col("n_name").alias("Nation"))
    return generated.symbol_lookup(spark).join(nations, "Sort").select("Sort", "Industry", "Symbol", "Logo", "Nation")
