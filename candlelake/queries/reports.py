"""Sorts, limits, sampling, report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlelake.operators import measures as m
from candlelake.operators import series
from candlelake.plans import market, report
from candlelake.queries.common import as_doubles, dim_symbol, rounded, stored
from candlelake.queries.ctes import with_ctes
from candlelake.queries.measures import GROWTH_TEXT_SQL, TREND_SQL
from candlelake.queries.registry import query
from candlelake.sources.generated import refresh_stamp, time_ranges


@query("top_n", with_ctes("""
    SELECT Symbol, Date, CAST(Close AS DOUBLE) AS Close FROM bars ORDER BY Symbol, Date LIMIT 100"""))
def top_n(spark, folder):
    rows = market.bars(spark, folder).orderBy("Symbol", "Date").limit(100)
    return as_doubles(rows.select("Symbol", "Date", "Close"))


@query("sort_by_column", with_ctes("""
    SELECT Symbol, Sort FROM dimsym ORDER BY Sort"""))
def sort_by_column(spark, folder):
    return dim_symbol(spark, folder).orderBy("Sort").select("Symbol", "Sort")


@query("summarize_series", with_ctes("""
    SELECT ExchangeName, Date, CAST(sum(Open) AS DOUBLE) AS SumOpen, CAST(min(Low) AS DOUBLE) AS MinLow,
           CAST(max(High) AS DOUBLE) AS MaxHigh, round(avg(Volume), 6) AS AvgVolume
    FROM bars GROUP BY ExchangeName, Date ORDER BY Date"""))
def summarize_series(spark, folder):
    points = report.summarize_series(market.bars(spark, folder), by=("ExchangeName", "Date"))
    return rounded(points, "AvgVolume")


def sampled_sql(points, blank):
    """Sampled days per symbol; ``blank`` is a condition on days without a value."""
    bins = (points - 2) // 2
    return with_ctes(f"""
    SELECT Symbol, Date, CAST(v AS DOUBLE) AS SumOpen FROM placed WHERE n <= {points}
    UNION ALL
    SELECT DISTINCT Symbol, Date, CAST(v AS DOUBLE) FROM (
      SELECT *, row_number() OVER (PARTITION BY Symbol, bin ORDER BY v, Date) AS lowest,
             row_number() OVER (PARTITION BY Symbol, bin ORDER BY v DESC, Date) AS highest
      FROM (SELECT *, CASE WHEN Date = d0 THEN -1 WHEN Date = d1 THEN {bins}
                   ELSE least(floor(CAST(Date - d0 AS DOUBLE) / (d1 - d0) * {bins}), {bins - 1}) END AS bin
            FROM placed WHERE v IS NOT NULL AND n > {points}))
    WHERE lowest = 1 OR highest = 1""", points=f"SELECT Symbol, Date, CASE WHEN {blank} THEN NULL ELSE so END AS v FROM days_sym",
    placed="""
    SELECT * FROM points JOIN (SELECT Symbol, min(Date) FILTER (v IS NOT NULL) AS d0, max(Date) FILTER (v IS NOT NULL) AS d1,
                                      count(*) AS n FROM points GROUP BY Symbol) USING (Symbol)""")


def sampled(spark, folder, points, blank):
    days = m.daily(market.bars(spark, folder), ["Symbol"]).select(
        "Symbol", "Date", F.when(~blank, F.col("SumOpen")).alias("SumOpen"))
    return as_doubles(series.downsample_minmax(stored(days, "days"), ["Symbol"], "Date", "SumOpen", points))


@query("downsample_minmax", sampled_sql(350, "false"))
def downsample_minmax(spark, folder):
    return sampled(spark, folder, 350, F.lit(False))


@query("downsample_minmax_blanks", sampled_sql(100, "day(Date) % 4 = 0"))
def downsample_minmax_blanks(spark, folder):
    return sampled(spark, folder, 100, F.dayofmonth("Date") % 4 == 0)


@query("downsample_minmax_default", sampled_sql(3500, "month(Date) = 5"))
def downsample_minmax_default(spark, folder):
    return sampled(spark, folder, series.MAX_POINTS, F.month("Date") == 5)


TOOLTIPS = """, CAST(so AS DOUBLE) AS SumOpen, CAST(lo AS DOUBLE) AS MinLow, CAST(hi AS DOUBLE) AS MaxHigh,
    round(CAST(sv AS DOUBLE) / cv, 6) AS AvgVolume"""


@query("report_series", with_ctes(TREND_SQL.format(name="5Y", extra=TOOLTIPS)))
def report_series(spark, folder):
    return rounded(report.series_report(market.bars(spark, folder), ["Symbol"], "5Y"), "AvgVolume")


@query("report_series_all", with_ctes(f"""
    SELECT d.Date, CASE WHEN lc >= fc THEN CAST(sc AS DOUBLE) END AS Green,
           CASE WHEN lc < fc THEN CAST(sc AS DOUBLE) END AS Red{TOOLTIPS}
    FROM inrange_all d JOIN growth_all g ON g.RangeName = d.RangeName WHERE d.RangeName = 'MAX'"""))
def report_series_all(spark, folder):
    return rounded(report.series_report(market.bars(spark, folder), [], "MAX"), "AvgVolume")


@query("report_series_months", with_ctes("""
    SELECT d.Symbol, CAST(date_trunc('month', d.Date) AS DATE) AS YearMonthDate,
           CASE WHEN max(lc) >= max(fc) THEN CAST(sum(sc) AS DOUBLE) END AS Green,
           CASE WHEN max(lc) < max(fc) THEN CAST(sum(sc) AS DOUBLE) END AS Red,
           CAST(sum(so) AS DOUBLE) AS SumOpen, CAST(min(lo) AS DOUBLE) AS MinLow, CAST(max(hi) AS DOUBLE) AS MaxHigh,
           round(CAST(sum(sv) AS DOUBLE) / CAST(sum(cv) AS DOUBLE), 6) AS AvgVolume
    FROM inrange_sym d JOIN growth_sym g ON g.Symbol = d.Symbol AND g.RangeName = d.RangeName
    WHERE d.RangeName = '5Y' GROUP BY d.Symbol, YearMonthDate"""))
def report_series_months(spark, folder):
    return rounded(report.month_report(market.bars(spark, folder), ["Symbol"], "5Y"), "AvgVolume")


@query("report_sparklines", with_ctes(TREND_SQL.format(name="30 Days", extra=", CAST(fc AS DOUBLE) AS ReferenceLine")))
def report_sparklines(spark, folder):
    return report.sparklines(market.bars(spark, folder))


COLOR_SQL = "CASE WHEN coalesce(lc, 0) >= coalesce(fc, 0) THEN '#039520' ELSE '#DD0012' END"


@query("report_symbol_cards", with_ctes(f"""
    SELECT Symbol, CAST(lc AS DOUBLE) AS LastClose, {GROWTH_TEXT_SQL} AS GrowthText, {COLOR_SQL} AS Color
    FROM growth_sym WHERE RangeName = '30 Days'"""))
def report_symbol_cards(spark, folder):
    return report.symbol_cards(market.bars(spark, folder))


@query("report_range_cards", with_ctes(f"""
    SELECT Symbol, RangeName, {GROWTH_TEXT_SQL} AS GrowthText, round(10000 * (1 + coalesce(g, 0)), 4) AS Investment
    FROM growth_sym WHERE RangeName IN ('30 Days', '90 Days', '1Y', '5Y')"""))
def report_range_cards(spark, folder):
    return rounded(report.range_cards(market.bars(spark, folder)), "Investment", digits=4)


@query("report_selection_cards", with_ctes(f"""
    SELECT Symbol, RangeName, CAST(fc AS DOUBLE) AS FirstClose, CAST(lc AS DOUBLE) AS LastClose,
           fd AS FirstTradingDate, t1 AS LastTradingDate, {GROWTH_TEXT_SQL} AS GrowthText,
           (SELECT max(ts) FROM events) AS Refreshed
    FROM growth_sym WHERE RangeName = 'YTD'"""))
def report_selection_cards(spark, folder):
    instants = market.table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("at"))
    stamp = refresh_stamp(instants, F.col("at"))
    return report.selection_cards(market.bars(spark, folder), ["Symbol"], "YTD", stamp)


@query("report_industry_pivot", with_ctes("""
    SELECT Industry, Symbol, IsTotal, round(g90, 6) AS Growth90, round(g1, 6) AS Growth1Y, round(g5, 6) AS Growth5Y FROM pivoted
    UNION ALL
    SELECT Industry, 'Average', 1, round(avg(g90), 6), round(avg(g1), 6), round(avg(g5), 6) FROM pivoted GROUP BY Industry""",
    pivoted="""
    SELECT Industry, Symbol, 0 AS IsTotal, max(g) FILTER (RangeName = '90 Days') AS g90,
           max(g) FILTER (RangeName = '1Y') AS g1, max(g) FILTER (RangeName = '5Y') AS g5
    FROM growth_isym GROUP BY Industry, Symbol"""))
def report_industry_pivot(spark, folder):
    pivot = report.industry_pivot(market.industry_star(spark, folder))
    return rounded(pivot, "Growth90", "Growth1Y", "Growth5Y")


@query("slicer_values", with_ctes("""
    SELECT Symbol, Sort, Logo, Symbol = 'NATION_7' AS IsDefault FROM dimsym"""))
def slicer_values(spark, folder):
    return report.slicer_values(dim_symbol(spark, folder), "NATION_7")


@query("slicer_ranges", with_ctes("""
    SELECT r.RangeName, r.SortOrder, r.RangeName = '30 Days' AS IsDefault, count(Date) AS n_days,
           '30 Days' AS SelectedRange
    FROM ranges r LEFT JOIN inrange_all i USING (RangeName) GROUP BY ALL"""))
def slicer_ranges(spark, folder):
    """The selectable ranges, the trading days each holds, and the choice when none is made."""
    ranges = time_ranges(spark)
    days = m.expand_ranges(m.daily(market.bars(spark, folder))).groupBy("RangeName").agg(F.count("Date").alias("n_days"))
    chosen = report.selected_range(ranges)
    return report.range_slicer(ranges).join(days, "RangeName", "left").select(
        "RangeName", "SortOrder", "IsDefault", F.coalesce("n_days", F.lit(0)).alias("n_days"),
        chosen.agg(F.max("SelectedRange")).scalar().alias("SelectedRange"))
