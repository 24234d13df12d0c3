"""Dimension and fact builds."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlelake.context import SILVER_SPEC
from candlelake.operators import dims, facts, sinks
from candlelake.operators.merge import scd_merge
from candlelake.plans import market
from candlelake.plans.silver import build_silver, flat_bronze, silver_source
from candlelake.queries import ctes
from candlelake.queries.common import (
    BATCH_1, BATCH_2, as_doubles, calendar_of, current, dim_of, dim_symbol, fact_of, id_checks, stored, stored_bars,
    trade_calendar)
from candlelake.queries.ctes import with_ctes
from candlelake.queries.registry import query
from candlelake.queries.scd import PRICES_SQL
from candlelake.schemas import empty_table
from candlelake.session import scratch_path
from candlelake.sources import responses


@query("dim_date_build", with_ctes("SELECT * FROM cal"))
def dim_date_build(spark, folder):
    return trade_calendar(spark, folder)


@query("dim_date_extend", with_ctes("SELECT * FROM cal", dates="""
    SELECT CAST(d AS DATE) AS Date FROM generate_series(
        make_timestamp((SELECT CAST(year(min(l_shipdate)) AS BIGINT) FROM lineitem), 1, 1, 0, 0, 0),
        make_timestamp((SELECT CAST(year(max(ts)) AS BIGINT) FROM events), 12, 31, 0, 0, 0), INTERVAL 1 DAY) AS g(d)"""))
def dim_date_extend(spark, folder):
    """A calendar of the later trading days grows back to all of them and on to the events."""
    shipped = market.table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("Date"))
    newer = market.table(spark, folder, "events").select(F.col("ts").cast("date").alias("Date"))
    return dims.extend_calendar(calendar_of(shipped.filter(F.year("Date") >= 1998)), shipped.unionByName(newer))


@query("dim_year_month", with_ctes("""
    SELECT Date, YearMonth, make_date(Year, MonthNumber, 1) AS YearMonthDate FROM cal"""))
def dim_year_month(spark, folder):
    return dims.with_first_of_month(trade_calendar(spark, folder)).select("Date", "YearMonth", "YearMonthDate")


@query("dim_symbol_build", with_ctes("SELECT * FROM dimsym"))
def dim_symbol_build(spark, folder):
    return dim_symbol(spark, folder)


def retyped(bars):
    """Bars whose symbols became funds in their later years."""
    kind = F.when(F.year("Date") >= 1998, F.lit("ETF")).otherwise(F.col("Type"))
    return current(bars.withColumn("Type", kind))


def two_dims(spark, folder):
    """Bars, and the symbol dimension before and after a delivery that holds old and new attributes."""
    rows, lookup = stored_bars(spark, folder), market.lookup(spark, folder)
    first = stored(dim_of(rows.filter(F.year("Date") < 1998), lookup), "dim")
    return rows, first, stored(dims.build_dim_symbol(first, retyped(rows), lookup, BATCH_2), "dim")


RETYPED_SQL = {
    "early": "SELECT Symbol FROM bars WHERE year(Date) < 1998 GROUP BY Symbol",
    "late": "SELECT Symbol FROM bars WHERE year(Date) >= 1998 GROUP BY Symbol"}


@query("dim_symbol_rebuild", with_ctes("""
    SELECT Symbol, 'Common Stock' AS Type, Symbol NOT IN (FROM late) AS __CurrentFlag, true AS IdIsUnique FROM early JOIN lookup USING (Symbol)
    UNION ALL
    SELECT Symbol, 'ETF', true, true FROM late JOIN lookup USING (Symbol)""", **RETYPED_SQL))
def dim_symbol_rebuild(spark, folder):
    dim = two_dims(spark, folder)[2]
    return dim.select("Symbol", "Type", "__CurrentFlag", id_checks("SymbolSID")[0])


@query("star_history", with_ctes("""
    SELECT l.Symbol, CASE WHEN l.Symbol IN (FROM late) THEN 'ETF' WHEN l.Symbol IS NOT NULL THEN 'Common Stock' END AS Type,
           Industry, count(*) AS n_days, CAST(sum(Close) AS DOUBLE) AS SumClose, min(b.Date) AS FirstDate, max(b.Date) AS LastDate
    FROM bars b LEFT JOIN (SELECT * FROM lookup WHERE Symbol IN (FROM early)) l USING (Symbol) GROUP BY 1, 2, 3""", **RETYPED_SQL))
def star_history(spark, folder):
    """Facts loaded under the first versions keep their symbols, under the attributes of the second."""
    rows, first, second = two_dims(spark, folder)
    fact = stored(fact_of(rows, first), "fact")
    star = facts.star(fact, trade_calendar(spark, folder), dims.member_dim(second))
    return star.groupBy("Symbol", "Type", "Industry").agg(
        F.count("*").alias("n_days"), F.sum("Close").cast("double").alias("SumClose"),
        F.min("Date").alias("FirstDate"), F.max("Date").alias("LastDate"))


FACT_SQL = f"""coalesce(SymbolSID, -1) AS SymbolSID, {PRICES_SQL}, DateID, __DeletedFlag, __FactKeyHash,
    __FactSCD1Hash, __CreatedBatchLogId, __CreateDateTime"""


def fact_out(fact, *checks):
    return as_doubles(fact.select("*", *checks).drop("TransactionSID")).withColumn(
        "SymbolSID", F.coalesce("SymbolSID", F.lit(-1).cast("bigint")))


@query("fact_daily_build", with_ctes(f"SELECT {FACT_SQL}, true AS IdIsUnique, true AS IdIsAbove FROM fact1"))
def fact_daily_build(spark, folder):
    rows = stored_bars(spark, folder)
    fact = stored(fact_of(rows, dim_of(rows, market.lookup(spark, folder))), "fact")
    return fact_out(fact, *id_checks("TransactionSID"))


@query("fact_daily_rebuild", with_ctes(f"""
    SELECT {FACT_SQL}, 'kept' AS IdState, true AS IdIsUnique FROM fact1 t
    WHERE EXISTS (SELECT 1 FROM fact2 s WHERE t.__FactKeyHash = s.__FactKeyHash AND t.__FactSCD1Hash = s.__FactSCD1Hash)
       OR DateID NOT BETWEEN (SELECT min(DateID) FROM fact2) AND (SELECT max(DateID) FROM fact2)
    UNION ALL
    SELECT {FACT_SQL}, 'new', true FROM fact2 s
    WHERE NOT EXISTS (SELECT 1 FROM fact1 t WHERE t.__FactKeyHash = s.__FactKeyHash AND t.__FactSCD1Hash = s.__FactSCD1Hash)""",
    fact2=ctes.CTES["fact1"].replace("factsrc", "factsrc2").replace(ctes.BATCH_1, ctes.BATCH_2).replace(ctes.LOAD_1, ctes.LOAD_2),
    factsrc2=ctes.CTES["factsrc"].replace("FROM bars b", "FROM corrected b") + " WHERE year(b.Date) >= 1998"))
def fact_daily_rebuild(spark, folder):
    """Kept facts keep their ids, all others get new ones."""
    rows = stored_bars(spark, folder)
    later = current(market.corrected_bars(rows).filter(F.year("Date") >= 1998))
    dim = stored(dim_of(rows, market.lookup(spark, folder)), "dim")
    scope = facts.covered_dates(later.select(facts.date_id(F.col("Date")).alias("DateID")))
    first = stored(fact_of(rows, dim), "fact")
    second = stored(facts.build_fact_daily(first, later, dim, BATCH_2, scope=scope), "fact")
    held = first.select("__FactKeyHash", "__FactSCD1Hash", F.col("TransactionSID").alias("held"))
    top = first.agg(F.max("TransactionSID")).scalar()
    state = (F.when(F.col("TransactionSID") == F.col("held"), "kept")
             .when(F.col("held").isNull() & (F.col("TransactionSID") > top), "new").otherwise("wrong"))
    joined = second.join(held, ["__FactKeyHash", "__FactSCD1Hash"], "left")
    return fact_out(joined, state.alias("IdState"), id_checks("TransactionSID")[0]).drop("held")


SILVER_SQL = f"""
    SELECT Symbol, ExchangeName, Currency, Type, ExchangeTimeZone, CAST(Date AS DATE) AS Date,
           CAST(Volume AS BIGINT) AS Volume, {PRICES_SQL.split(',', 1)[1]}, {ctes.VERSION}, __lastmodified,
           __HashKey, __HashValue, {ctes.BATCH} FROM """
DELIVERED_SQL = {
    "silver1": ctes.silver("flatset", ctes.LOAD_1, ctes.BATCH_1),
    "silver2": ctes.silver("flatset2", ctes.LOAD_2, ctes.BATCH_2),
    "flatset2": "SELECT DISTINCT * FROM flat2",
    "flat2": ctes.CTES["flat"].replace("FROM bars b", "FROM corrected b")}


@query("silver_build", with_ctes(SILVER_SQL + "silver1", **DELIVERED_SQL))
def silver_build(spark, folder):
    return as_doubles(build_silver(empty_table(spark, "silver"), market.responses(spark, folder), BATCH_1))


@query("silver_rebuild", with_ctes(SILVER_SQL + "silver_merged", **DELIVERED_SQL))
def silver_rebuild(spark, folder):
    """Two deliveries, each through stored bronze."""
    rows, path = stored_bars(spark, folder), scratch_path(spark, "bronze")
    silver = empty_table(spark, "silver")
    for daily, batch in ((rows, BATCH_1), (market.corrected_bars(rows), BATCH_2)):
        good = stored(responses.accept(market.responses_of(daily)), "accepted")
        sinks.overwrite_partitions(good, path)
        bronze = responses.read_bronze(spark, path, good.select("symbol"))
        silver = stored(scd_merge(silver, silver_source(flat_bronze(bronze), batch), SILVER_SPEC, batch), "silver")
    return as_doubles(silver)


@query("calc_open_dates", with_ctes("SELECT * FROM cal WHERE (SELECT sum(Open) FROM bars) > 0"))
def calc_open_dates(spark, folder):
    rows = stored_bars(spark, folder)
    return dims.open_dates(calendar_of(rows), rows)
