"""Aggregations and time-range measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlelake.functions.values import growth_text, investment_growth, trend_color
from candlelake.operators import measures as m
from candlelake.plans import market, report
from candlelake.queries.common import rounded
from candlelake.queries.ctes import with_ctes
from candlelake.queries.registry import query
from candlelake.sources.generated import refresh_stamp

def by_symbol(names, spark, folder):
    return m.measure(market.bars(spark, folder), names, ["Symbol"])


@query("agg_sum_close", with_ctes("SELECT Symbol, CAST(sum(Close) AS DOUBLE) AS SumClose FROM bars GROUP BY Symbol"))
def agg_sum_close(spark, folder):
    return by_symbol(["SumClose"], spark, folder)


@query("agg_sum_open", with_ctes("SELECT Symbol, CAST(sum(Open) AS DOUBLE) AS SumOpen FROM bars GROUP BY Symbol"))
def agg_sum_open(spark, folder):
    return by_symbol(["SumOpen"], spark, folder)


@query("agg_min_low", with_ctes("SELECT Symbol, CAST(min(Low) AS DOUBLE) AS MinLow FROM bars GROUP BY Symbol"))
def agg_min_low(spark, folder):
    return by_symbol(["MinLow"], spark, folder)


@query("agg_max_high", with_ctes("SELECT Symbol, CAST(max(High) AS DOUBLE) AS MaxHigh FROM bars GROUP BY Symbol"))
def agg_max_high(spark, folder):
    return by_symbol(["MaxHigh"], spark, folder)


@query("agg_avg_volume", with_ctes("SELECT Symbol, round(avg(Volume), 6) AS AvgVolume FROM bars GROUP BY Symbol"))
def agg_avg_volume(spark, folder):
    return rounded(by_symbol(["AvgVolume"], spark, folder), "AvgVolume")


@query("agg_date_bounds", with_ctes("SELECT min(Date) AS MinDate, max(Date) AS MaxDate FROM bars"))
def agg_date_bounds(spark, folder):
    return m.measure(market.bars(spark, folder), ["MinDate", "MaxDate"])


@query("agg_row_gain_avg", with_ctes("""
    SELECT Symbol, round(avg((CAST(Close AS DOUBLE) - CAST(Open AS DOUBLE)) / nullif(CAST(Open AS DOUBLE), 0)), 6) AS AvgGain
    FROM bars GROUP BY Symbol"""))
def agg_row_gain_avg(spark, folder):
    return rounded(by_symbol(["AvgGain"], spark, folder), "AvgGain")


@query("agg_max_refresh", """
    SELECT max(ts) - INTERVAL 6 HOUR AS MaxMdt, max(ts) AS MaxUtc FROM events""")
def agg_max_refresh(spark, folder):
    instants = market.table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("at"))
    return refresh_stamp(instants, F.col("at"), "-06:00").agg(
        F.max("MdtDateTime").alias("MaxMdt"), F.max("UtcDateTime").alias("MaxUtc"))


@query("agg_max_logo", with_ctes("SELECT Industry, max(Logo) AS Logo FROM istar GROUP BY Industry"))
def agg_max_logo(spark, folder):
    return m.max_text(market.industry_star(spark, folder), "Logo", ["Industry"])


@query("selected_value", with_ctes("""
    SELECT ExchangeName, Date, CASE WHEN count(DISTINCT Symbol) = 1 THEN max(Symbol) END AS Symbol
    FROM bars GROUP BY ExchangeName, Date"""))
def selected_value(spark, folder):
    return m.selected_value(market.bars(spark, folder), "Symbol", ["ExchangeName", "Date"])


@query("selected_value_default", with_ctes("""
    SELECT Symbol, Month, CASE WHEN count(DISTINCT Volume) = 1 THEN max(Volume) ELSE -1 END AS Volume
    FROM (SELECT Symbol, Volume, CAST(date_trunc('month', Date) AS DATE) AS Month FROM bars) GROUP BY Symbol, Month"""))
def selected_value_default(spark, folder):
    months = market.bars(spark, folder).withColumn("Month", F.trunc("Date", "month"))
    return m.selected_value(months, "Volume", ["Symbol", "Month"], default=-1)


@query("agg_count_rows", with_ctes("SELECT count(*) AS Points FROM (SELECT DISTINCT Symbol, Date FROM bars)"))
def agg_count_rows(spark, folder):
    points = report.summarize_series(market.bars(spark, folder), by=("Symbol", "Date"))
    return points.agg(F.count(F.lit(1)).alias("Points"))


@query("agg_subtotal_rollup", with_ctes("""
    SELECT Symbol, 0 AS IsTotal, round(g, 6) AS Growth FROM growth_sym WHERE RangeName = '1Y'
    UNION ALL
    SELECT 'Average', 1, round(avg(g), 6) FROM growth_sym WHERE RangeName = '1Y'"""))
def agg_subtotal_rollup(spark, folder):
    growths = m.growth_by_range(market.bars(spark, folder), ["Symbol"], ["1Y"])
    return rounded(report.with_average_rows(growths, [], ["Growth"]), "Growth")


# -- time ranges ----------------------------------------------------------------------------

@query("last_trading_date", with_ctes("SELECT Symbol, t1 AS LastTradingDate FROM anchor_sym"))
def last_trading_date(spark, folder):
    return m.last_trading_date(m.daily(market.bars(spark, folder), ["Symbol"]), ["Symbol"])


@query("last_trading_date_industry", with_ctes("SELECT Industry, t1 AS LastTradingDate FROM anchor_ind"))
def last_trading_date_industry(spark, folder):
    days = m.daily(market.industry_star(spark, folder), ["Industry"])
    return m.last_trading_date(days, ["Industry"])


@query("range_bounds", with_ctes("""
    SELECT Industry, RangeName, SortOrder, coalesce(t0, DATE '1900-01-01') AS RangeStart, t1 AS LastTradingDate
    FROM bounds_ind"""))
def range_bounds(spark, folder):
    days = m.daily(market.industry_star(spark, folder), ["Industry"])
    bounds = m.with_range_bounds(m.last_trading_date(days, ["Industry"]))
    return bounds.withColumn("RangeStart", F.coalesce("RangeStart", F.lit("1900-01-01").cast("date")))


@query("range_filter", with_ctes("""
    SELECT Symbol, RangeName, CAST(sum(so) AS DOUBLE) AS SumOpen, CAST(min(lo) AS DOUBLE) AS MinLow,
           CAST(max(hi) AS DOUBLE) AS MaxHigh,
           round(CAST(sum(sv) AS DOUBLE) / CAST(sum(cv) AS DOUBLE), 6) AS AvgVolume
    FROM inrange_sym GROUP BY Symbol, RangeName"""))
def range_filter(spark, folder):
    days = m.daily(market.bars(spark, folder), ["Symbol"])
    ranged = m.reaggregate(m.expand_ranges(days, ["Symbol"]), ["Symbol", "RangeName"])
    return rounded(ranged.drop("SumClose"), "AvgVolume")


def endpoints(spark, folder):
    return m.range_endpoints(market.bars(spark, folder), ["Symbol"])


@query("first_trading_date", with_ctes("SELECT Symbol, RangeName, fd AS FirstTradingDate FROM growth_sym"))
def first_trading_date(spark, folder):
    return endpoints(spark, folder).select("Symbol", "RangeName", "FirstTradingDate")


@query("first_close", with_ctes("SELECT Symbol, RangeName, CAST(fc AS DOUBLE) AS FirstClose FROM growth_sym"))
def first_close(spark, folder):
    return endpoints(spark, folder).select("Symbol", "RangeName", F.col("FirstClose").cast("double").alias("FirstClose"))


@query("last_close", with_ctes("SELECT Symbol, RangeName, CAST(lc AS DOUBLE) AS LastClose FROM growth_sym"))
def last_close(spark, folder):
    return endpoints(spark, folder).select("Symbol", "RangeName", F.col("LastClose").cast("double").alias("LastClose"))


@query("close_in_range", with_ctes("SELECT Symbol, RangeName, Date, CAST(sc AS DOUBLE) AS Close FROM inrange_sym"))
def close_in_range(spark, folder):
    days = m.daily(market.bars(spark, folder), ["Symbol"])
    return m.expand_ranges(days, ["Symbol"]).select(
        "Symbol", "RangeName", "Date", F.col("SumClose").cast("double").alias("Close"))


def grown(star, by):
    return rounded(m.growth_by_range(star, by).select(*by, "RangeName", "Growth"), "Growth")


@query("growth_pct", with_ctes("SELECT Symbol, RangeName, round(g, 6) AS Growth FROM growth_sym"))
def growth_pct(spark, folder):
    return grown(market.bars(spark, folder), ["Symbol"])


@query("growth_pct_industry", with_ctes("SELECT Industry, RangeName, round(g, 6) AS Growth FROM growth_ind"))
def growth_pct_industry(spark, folder):
    return grown(market.industry_star(spark, folder), ["Industry"])


@query("growth_pct_all", with_ctes("SELECT RangeName, round(g, 6) AS Growth FROM growth_all"))
def growth_pct_all(spark, folder):
    return grown(market.bars(spark, folder), [])


@query("investment_growth", with_ctes("""
    SELECT Symbol, RangeName, round(10000 * (1 + coalesce(g, 0)), 4) AS Investment FROM growth_sym"""))
def investment_worth(spark, folder):
    growths = m.growth_by_range(market.bars(spark, folder), ["Symbol"])
    return rounded(growths.select("Symbol", "RangeName", investment_growth(F.col("Growth")).alias("Investment")),
                   "Investment", digits=4)


@query("avg_growth_by_range", with_ctes("""
    SELECT Industry, RangeName, round(avg(g), 6) AS AvgGrowth FROM growth_isym
    WHERE RangeName IN ('30 Days', '90 Days', '1Y', '5Y') GROUP BY Industry, RangeName"""))
def avg_growth_by_range(spark, folder):
    means = m.average_growth(market.industry_star(spark, folder), ["Industry"], report.CARD_RANGES)
    return rounded(means.drop("SortOrder"), "AvgGrowth")


TREND_SQL = """
    SELECT d.Symbol, d.Date,
           CASE WHEN coalesce(lc, 0) - coalesce(fc, 0) >= 0 THEN CAST(sc AS DOUBLE) END AS Green,
           CASE WHEN coalesce(lc, 0) - coalesce(fc, 0) < 0 THEN CAST(sc AS DOUBLE) END AS Red{extra}
    FROM inrange_sym d JOIN growth_sym g ON g.Symbol = d.Symbol AND g.RangeName = d.RangeName
    WHERE d.RangeName = '{name}'"""


@query("trend_split", with_ctes(TREND_SQL.format(name="1Y", extra="")))
def trend_split(spark, folder):
    series = m.with_endpoints(market.bars(spark, folder), ["Symbol"], "1Y")
    return report.trend_split(series).select("Symbol", "Date", "Green", "Red")


@query("trend_color", with_ctes("""
    SELECT Symbol, RangeName, CASE WHEN coalesce(lc, 0) >= coalesce(fc, 0) THEN '#039520' ELSE '#DD0012' END AS Color
    FROM growth_sym"""))
def trend_colors(spark, folder):
    return endpoints(spark, folder).select(
        "Symbol", "RangeName", trend_color(F.col("LastClose"), F.col("FirstClose")).alias("Color"))


GROWTH_TEXT_SQL = """
    coalesce(CASE WHEN round(g * 100, 2) > 0 THEN '+' ELSE '' END
             || CAST(CAST(round(g * 100, 2) AS DECIMAL(18,2)) AS VARCHAR) || '%', '')"""


@query("growth_text", with_ctes(f"SELECT Symbol, RangeName, {GROWTH_TEXT_SQL} AS GrowthText FROM growth_sym"))
def growth_texts(spark, folder):
    growths = m.growth_by_range(market.bars(spark, folder), ["Symbol"])
    return growths.select("Symbol", "RangeName", growth_text(F.col("Growth")).alias("GrowthText"))
