"""Joins, keys, audit columns and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlelake.context import DIM_SYMBOL_SPEC, FACT_DAILY_SPEC, SILVER_SPEC, TableSpec
from candlelake.functions import keys
from candlelake.functions.dates import RANGE_NAMES
from candlelake.operators import dims, facts, measures, merge
from candlelake.operators.audit import add_audit_columns
from candlelake.operators.surrogate import assign_surrogates, positions
from candlelake.plans import market
from candlelake.queries import ctes
from candlelake.queries.common import (
    id_checks, BATCH_1, BATCH_2, CUSTOMER_SPEC, as_doubles, calendar_of, current, customer_load, customer_reload, dim_of, fact_of,
    silver_again, silver_of, stored, stored_bars)
from candlelake.queries.ctes import sha, with_ctes
from candlelake.queries.registry import query

CUSTOMER_DIM_SQL = """
    c_custkey, c_mktsegment, CAST(c_acctbal AS DOUBLE) AS c_acctbal, __CurrentFlag, __DeletedFlag,
    __EffectiveStartDateTime, __EffectiveEndDateTime, __BusinessKeyHash, __Hash1Type, __Hash2Type,
    __CreatedBatchLogId, __UpdatedBatchLogId, __CreateDateTime, __UpdateDateTime"""

PRICES_SQL = """
    Volume, CAST(High AS DOUBLE) AS High, CAST(Low AS DOUBLE) AS Low, CAST(Close AS DOUBLE) AS Close,
    CAST(Open AS DOUBLE) AS Open"""

STRICT_CUSTOMER_SPEC = TableSpec("Dim", ("c_custkey",), ("c_acctbal",), strict=True)
STRICT_FACT_SPEC = TableSpec("Fact", FACT_DAILY_SPEC.business_columns, FACT_DAILY_SPEC.type1_columns, strict=True)


def silver_fact(bars, batch, spec=FACT_DAILY_SPEC):
    """Facts keyed by the symbol text, for syncs without a dimension."""
    rows = bars.select(F.col("Symbol").alias("SymbolSID"), *facts.PRICE_COLUMNS,
                       facts.date_id(F.col("Date")).alias("DateID"))
    return add_audit_columns(rows, spec, batch)


# -- joins ----------------------------------------------------------------------------------

@query("join_lookup_enrich", with_ctes("SELECT DISTINCT Symbol, ExchangeName, Currency, Sort, Industry, Logo FROM bars JOIN lookup USING (Symbol)"))
def join_lookup_enrich(spark, folder):
    rows = dims.symbol_candidates(current(market.bars(spark, folder)), market.lookup(spark, folder))
    return rows.select("Symbol", "ExchangeName", "Currency", "Sort", "Industry", "Logo")


@query("join_fact_to_dim_key", with_ctes(f"""
    SELECT coalesce(SymbolSID, -1) AS SymbolSID, {PRICES_SQL}, DateID FROM factsrc"""))
def join_fact_to_dim_key(spark, folder):
    rows = stored_bars(spark, folder)
    keyed = facts.with_dim_key(current(rows), dim_of(rows, market.lookup(spark, folder)))
    return as_doubles(keyed.drop(DIM_SYMBOL_SPEC.key_hash).withColumn(
        "SymbolSID", F.coalesce("SymbolSID", F.lit(-1).cast("bigint"))))


@query("join_merge_matched", with_ctes("""
    SELECT t.c_custkey, t.__Hash2Type, s.__Hash2Type AS NewHash
    FROM dim1 t JOIN dim2 s ON s.__BusinessKeyHash = t.__BusinessKeyHash AND s.__Hash2Type <> t.__Hash2Type"""))
def join_merge_matched(spark, folder):
    matched = merge.matched_changes(customer_load(spark, folder), customer_reload(spark, folder), CUSTOMER_SPEC)
    return matched.select("c_custkey", "__Hash2Type", "NewHash")


@query("join_merge_not_matched", with_ctes("""
    SELECT c_custkey, c_mktsegment FROM dim2 s
    WHERE NOT EXISTS (SELECT 1 FROM dim1 t WHERE t.__BusinessKeyHash = s.__BusinessKeyHash)"""))
def join_merge_not_matched(spark, folder):
    new = merge.not_matched(customer_load(spark, folder), customer_reload(spark, folder), CUSTOMER_SPEC)
    return new.select("c_custkey", "c_mktsegment")


@query("join_not_matched_by_source", with_ctes("""
    SELECT c_custkey, c_mktsegment FROM dim1 t
    WHERE NOT EXISTS (SELECT 1 FROM dim2 s WHERE t.__BusinessKeyHash = s.__BusinessKeyHash)"""))
def join_not_matched_by_source(spark, folder):
    gone = merge.not_matched_by_source(customer_load(spark, folder), customer_reload(spark, folder), CUSTOMER_SPEC)
    return gone.select("c_custkey", "c_mktsegment")


@query("join_star", with_ctes("""
    SELECT f.DateID, YearMonth, DayOfWeek, coalesce(Symbol, '') AS Symbol, coalesce(Industry, '') AS Industry,
           CAST(Close AS DOUBLE) AS Close, Volume
    FROM fact1 f LEFT JOIN cal USING (DateID) LEFT JOIN dimsym d ON d.SymbolSID = f.SymbolSID"""))
def join_star(spark, folder):
    rows = stored_bars(spark, folder)
    dim = stored(dim_of(rows, market.lookup(spark, folder)), "dim")
    joined = facts.star(fact_of(rows, dim), calendar_of(rows), dims.current_dim(dim))
    blank = {name: F.coalesce(name, F.lit("")) for name in ("Symbol", "Industry")}
    return as_doubles(joined.withColumns(blank).select(
        "DateID", "YearMonth", "DayOfWeek", "Symbol", "Industry", "Close", "Volume"))


@query("join_param_ranges", with_ctes("""
    SELECT Symbol, RangeName, SortOrder, coalesce(t0, DATE '1900-01-01') AS RangeStart, t1 AS LastTradingDate
    FROM bounds_sym"""))
def join_param_ranges(spark, folder):
    days = measures.daily(market.bars(spark, folder), ["Symbol"])
    bounds = measures.with_range_bounds(measures.last_trading_date(days, ["Symbol"]), RANGE_NAMES)
    return bounds.withColumn("RangeStart", F.coalesce("RangeStart", F.lit("1900-01-01").cast("date")))


# -- keys and audit -------------------------------------------------------------------------

@query("hash_key", with_ctes(f"SELECT Symbol, Date, {sha(*ctes.SILVER_KEY)} AS HashKey FROM bars"))
def hash_key(spark, folder):
    return market.bars(spark, folder).select("Symbol", "Date", keys.business_hash(SILVER_SPEC).alias("HashKey"))


@query("hash_change", with_ctes(f"SELECT Symbol, Date, {sha(*ctes.SILVER_TRACKED)} AS HashValue FROM bars"))
def hash_change(spark, folder):
    rows = market.bars(spark, folder)
    return rows.select("Symbol", "Date", keys.change_hash(rows.columns, SILVER_SPEC).alias("HashValue"))


@query("hash_type1", with_ctes(f"""
    SELECT Symbol, Date, {sha(*ctes.FACT_TRACKED)} AS FactHash, sha256('') AS EmptyHash FROM bars"""))
def hash_type1(spark, folder):
    return market.bars(spark, folder).select(
        "Symbol", "Date", keys.type1_hash(FACT_DAILY_SPEC).alias("FactHash"),
        keys.type1_hash(DIM_SYMBOL_SPEC).alias("EmptyHash"))


@query("audit_stage", with_ctes("""
    SELECT * REPLACE (CAST(High AS DOUBLE) AS High, CAST(Low AS DOUBLE) AS Low, CAST(Close AS DOUBLE) AS Close,
                      CAST(Open AS DOUBLE) AS Open) FROM silver1"""))
def audit_stage(spark, folder):
    return as_doubles(silver_of(market.bars(spark, folder)))


@query("audit_dim", with_ctes(f"SELECT {CUSTOMER_DIM_SQL} FROM dim1"))
def audit_dim(spark, folder):
    return as_doubles(customer_load(spark, folder))


FACT_BY_SYMBOL = f"""
    SELECT Symbol AS SymbolSID, Volume, High, Low, Open, Close, CAST(strftime(Date, '%Y%m%d') AS INTEGER) AS DateID,
           false AS __DeletedFlag, sha256(concat_ws('|', Symbol, strftime(Date, '%Y%m%d'))) AS __FactKeyHash,
           {sha(*ctes.FACT_TRACKED)} AS __FactSCD1Hash,
           """
FACTS_OLD = FACT_BY_SYMBOL + f"'{ctes.BATCH_1}' AS __CreatedBatchLogId, TIMESTAMP '{ctes.LOAD_1}' AS __CreateDateTime FROM bars"
FACTS_NEW = FACT_BY_SYMBOL + f"'{ctes.BATCH_2}' AS __CreatedBatchLogId, TIMESTAMP '{ctes.LOAD_2}' AS __CreateDateTime FROM corrected"
FACT_SQL = f"""SymbolSID, {PRICES_SQL}, DateID, __DeletedFlag, __FactKeyHash, __FactSCD1Hash,
    __CreatedBatchLogId, __CreateDateTime"""


@query("audit_fact", with_ctes(f"SELECT {FACT_SQL} FROM facts_old", facts_old=FACTS_OLD))
def audit_fact(spark, folder):
    return as_doubles(silver_fact(market.bars(spark, folder), BATCH_1))


# -- merges ---------------------------------------------------------------------------------

@query("scd2_stage_merge", with_ctes(f"""
    SELECT Symbol, Date, {PRICES_SQL}, __CurrentFlag, __EffectiveStartDateTime, __EffectiveEndDateTime,
           __lastmodified, __HashKey, __HashValue, __CreatedBatchLogId, __UpdatedBatchLogId, __UpdateDateTime
    FROM silver_merged"""))
def scd2_stage_merge(spark, folder):
    rows = stored_bars(spark, folder)
    merged = merge.scd_merge(silver_of(rows), silver_again(rows), SILVER_SPEC, BATCH_2)
    return as_doubles(merged.select(
        "Symbol", "Date", *facts.PRICE_COLUMNS, "__CurrentFlag", "__EffectiveStartDateTime",
        "__EffectiveEndDateTime", "__lastmodified", "__HashKey", "__HashValue", "__CreatedBatchLogId",
        "__UpdatedBatchLogId", "__UpdateDateTime"))


@query("scd1_dim_update", with_ctes(f"SELECT {CUSTOMER_DIM_SQL} FROM dim_overwritten"))
def scd1_dim_update(spark, folder):
    return as_doubles(merge.type1_update(
        customer_load(spark, folder), customer_reload(spark, folder), CUSTOMER_SPEC, BATCH_2))


@query("scd1_dim_update_strict", with_ctes(f"""
    SELECT {CUSTOMER_DIM_SQL.replace('__Hash1Type', 'h AS __Hash1Type')}
    FROM (SELECT o.*, t.__Hash1Type AS h FROM dim_overwritten o JOIN dim1 t USING (c_custkey))"""))
def scd1_dim_update_strict(spark, folder):
    target = add_audit_columns(market.first_customers(spark, folder), STRICT_CUSTOMER_SPEC, BATCH_1)
    source = add_audit_columns(market.second_customers(spark, folder), STRICT_CUSTOMER_SPEC, BATCH_2)
    return as_doubles(merge.type1_update(target, source, STRICT_CUSTOMER_SPEC, BATCH_2))


@query("scd2_dim_merge", with_ctes(f"SELECT {CUSTOMER_DIM_SQL} FROM dim_merged"))
def scd2_dim_merge(spark, folder):
    return as_doubles(merge.scd_merge(
        customer_load(spark, folder), customer_reload(spark, folder), CUSTOMER_SPEC, BATCH_2))


@query("fact_sync_merge", with_ctes(f"""
    SELECT {FACT_SQL} FROM (
      SELECT t.* FROM facts_old t JOIN facts_new s
        ON s.__FactKeyHash = t.__FactKeyHash AND s.__FactSCD1Hash = t.__FactSCD1Hash
      UNION ALL
      SELECT s.* FROM facts_new s WHERE NOT EXISTS (
        SELECT 1 FROM facts_old t WHERE s.__FactKeyHash = t.__FactKeyHash AND s.__FactSCD1Hash = t.__FactSCD1Hash)
      UNION ALL
      SELECT t.* FROM facts_old t WHERE DateID NOT BETWEEN (SELECT min(DateID) FROM facts_new) AND (SELECT max(DateID) FROM facts_new))""",
    facts_old=FACTS_OLD, facts_new=FACTS_NEW + " WHERE year(Date) >= 1998"))
def fact_sync_merge(spark, folder):
    rows = stored_bars(spark, folder)
    target = silver_fact(rows, BATCH_1)
    source = silver_fact(market.corrected_bars(rows).filter(F.year("Date") >= 1998), BATCH_2)
    return as_doubles(merge.fact_sync(target, source, FACT_DAILY_SPEC, facts.covered_dates(source)))


@query("fact_sync_merge_strict", with_ctes(f"""
    SELECT {FACT_SQL} FROM (
      SELECT t.* FROM facts_old t JOIN facts_new s
        ON s.__FactKeyHash = t.__FactKeyHash AND s.__FactSCD1Hash = t.__FactSCD1Hash
      UNION ALL
      SELECT s.* FROM facts_new s WHERE NOT EXISTS (
        SELECT 1 FROM facts_old t WHERE s.__FactKeyHash = t.__FactKeyHash))""",
    facts_old=FACTS_OLD, facts_new=FACTS_NEW))
def fact_sync_merge_strict(spark, folder):
    rows = stored_bars(spark, folder)
    target = silver_fact(rows, BATCH_1, STRICT_FACT_SPEC)
    source = silver_fact(market.corrected_bars(rows), BATCH_2, STRICT_FACT_SPEC)
    return as_doubles(merge.fact_sync(target, source, STRICT_FACT_SPEC))


@query("surrogate_key_dense", with_ctes("""
    SELECT row_number() OVER (ORDER BY __HashKey) AS RowSID, Symbol, Date FROM silver1"""))
def surrogate_key_dense(spark, folder):
    numbered = positions(silver_of(market.bars(spark, folder)), F.col("__HashKey"), "RowSID")
    return numbered.select("RowSID", "Symbol", "Date")


@query("surrogate_key", with_ctes("SELECT Symbol, Date, true AS IdIsUnique, true AS IdIsAbove FROM silver1"))
def surrogate_key(spark, folder):
    numbered = assign_surrogates(silver_of(market.bars(spark, folder)), "RowSID", F.lit(1000))
    return stored(numbered, "numbered").select("Symbol", "Date", *id_checks("RowSID", 1000))


@query("merge_source_check", with_ctes(f"""
    SELECT {sha(*ctes.SILVER_KEY)} AS __HashKey, count(*) AS RowCount
    FROM (SELECT Symbol, ExchangeName, Currency, CAST(date_trunc('year', Date) AS DATE) AS Date FROM bars)
    GROUP BY 1 HAVING count(*) > 1"""))
def merge_source_check(spark, folder):
    yearly = market.bars(spark, folder).withColumn("Date", F.trunc("Date", "year"))
    return merge.duplicate_keys(add_audit_columns(yearly, SILVER_SPEC, BATCH_1), SILVER_SPEC)
