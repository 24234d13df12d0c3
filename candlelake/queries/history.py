"""Stored tables over time: deliveries in any order, pruned reads, maintained states, upkeep."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from candlelake.context import SILVER_SPEC, BatchContext
from candlelake.operators import buckets, facts, history, ranges, series, sinks, states, upkeep
from candlelake.operators import measures as m
from candlelake.operators.audit import add_audit_columns
from candlelake.plans import market
from candlelake.plans.lake import Lake
from candlelake.queries import ctes
from candlelake.queries.common import (
    BATCH_1, BATCH_2, as_doubles, calendar_of, dim_of, fact_of, rounded, silver_again, silver_of, stored, stored_bars)
from candlelake.queries.ctes import with_ctes
from candlelake.queries.registry import query
from candlelake.queries.scd import PRICES_SQL
from candlelake.schemas import empty_of
from candlelake.session import scratch_path
from candlelake.sources.responses import accept

LOAD_3 = "2024-03-01 00:00:00"
BATCH_3 = BatchContext("batch-3", datetime.fromisoformat(LOAD_3))


def own_name(label):
    """A catalog name no other run uses."""
    return f"{label}_{uuid.uuid4().hex[:12]}"


def by_month(df, label, column="Date"):
    """A catalog table partitioned by month."""
    name, path = own_name(label), scratch_path(df.sparkSession, label)
    rows = df.withColumn("Month", F.year(column) * 100 + F.month(column))
    rows.hint("rebalance", "Month").write.partitionBy("Month").option("path", path).saveAsTable(name)
    return name


# -- reads that touch their months ----------------------------------------------------------

@query("star_months", with_ctes("""
    SELECT f.DateID, YearMonth, coalesce(Symbol, '') AS Symbol, coalesce(Industry, '') AS Industry,
           CAST(Close AS DOUBLE) AS Close, Volume
    FROM fact1 f JOIN cal USING (DateID) LEFT JOIN dimsym d ON d.SymbolSID = f.SymbolSID
    WHERE Date BETWEEN DATE '1996-11-15' AND DATE '1997-02-10'"""))
def star_months(spark, folder):
    """A few months of a fact stored by month, chosen by a condition on the calendar."""
    rows = stored_bars(spark, folder)
    dim = stored(dim_of(rows, market.lookup(spark, folder)), "dim")
    name = by_month(fact_of(rows, dim).withColumn("Day", F.to_date(F.col("DateID").cast("string"), "yyyyMMdd")),
                    "fact", "Day")
    star = facts.star(spark.table(name).drop("Day"), stored(calendar_of(rows), "calendar"),
                      dim.select("SymbolSID", "Symbol", "Industry"), "Month")
    some = star.filter(F.col("Date").between("1996-11-15", "1997-02-10"))
    blank = {column: F.coalesce(column, F.lit("")) for column in ("Symbol", "Industry")}
    return as_doubles(some.withColumns(blank).select("DateID", "YearMonth", "Symbol", "Industry", "Close", "Volume"))


# -- deliveries out of order ----------------------------------------------------------------

ORDERED_SQL = f"""
    WITH_ROWS AS (
      SELECT Symbol, Date, Volume, High, Low, Open, Close, __HashKey, __HashValue, __CreatedBatchLogId,
             __EffectiveStartDateTime AS s,
             lag(__HashValue) OVER w IS DISTINCT FROM __HashValue AS opens
      FROM (FROM silver1 UNION ALL FROM silver2 UNION ALL FROM silver3)
      WINDOW w AS (PARTITION BY __HashKey ORDER BY __EffectiveStartDateTime))
    SELECT Symbol, Date, {PRICES_SQL}, __HashKey, __HashValue, __CreatedBatchLogId,
           s AS __EffectiveStartDateTime,
           coalesce(lead(s) OVER k - INTERVAL 1 SECOND, TIMESTAMP '{ctes.OPEN_END}') AS __EffectiveEndDateTime,
           lead(s) OVER k IS NULL AS __CurrentFlag, coalesce(lead(s) OVER k, s) AS __lastmodified,
           lead(__CreatedBatchLogId) OVER k AS __UpdatedBatchLogId
    FROM WITH_ROWS WHERE opens WINDOW k AS (PARTITION BY __HashKey ORDER BY s)"""
VERSIONS = ("Symbol", "Date", *facts.PRICE_COLUMNS, "__HashKey", "__HashValue", "__CreatedBatchLogId",
            "__EffectiveStartDateTime", "__EffectiveEndDateTime", "__CurrentFlag", "__lastmodified", "__UpdatedBatchLogId")
THIRD_SQL = {"silver3": ctes.silver("(SELECT * FROM bars WHERE ExchangeName <> 'ASIA')", LOAD_3, "batch-3")}


def ordered_sql():
    """Gaps and islands over all deliveries."""
    rows, body = ORDERED_SQL.split("SELECT Symbol, Date, \n", 1)
    inner = rows.strip().removeprefix("WITH_ROWS AS (").rstrip().removesuffix(")")
    return with_ctes("SELECT Symbol, Date, \n" + body.replace("WITH_ROWS", "delivered_rows"),
                     delivered_rows=inner, **THIRD_SQL)


def three_deliveries(bars):
    """Bars, corrected bars, and all but the Asian bars as they were at first."""
    third = add_audit_columns(bars.filter(F.col("ExchangeName") != "ASIA"), SILVER_SPEC, BATCH_3)
    return {1: silver_of(bars), 2: silver_again(bars), 3: third}


@query("splice_any_order", ordered_sql())
def splice_any_order(spark, folder):
    """The third delivery comes first, the first second, the second last."""
    deliveries = {number: stored(rows, "delivery") for number, rows in three_deliveries(stored_bars(spark, folder)).items()}
    target, kept = empty_of(spark, deliveries[1].schema), None
    for number in (3, 1, 2):
        target = stored(history.splice_merge(target, deliveries[number], SILVER_SPEC, kept), "spliced")
        kept = deliveries[number] if kept is None else kept.unionByName(deliveries[number])
    return as_doubles(target.select(*VERSIONS))


@query("versions_fold", ordered_sql())
def versions_fold(spark, folder):
    """The same versions in one pass over all deliveries."""
    one, two, three = three_deliveries(stored_bars(spark, folder)).values()
    return as_doubles(history.fold_versions(two.unionByName(three).unionByName(one), SILVER_SPEC).select(*VERSIONS))


@query("delivery_replay", with_ctes("""
    SELECT Symbol, CAST(Date AS DATE) AS Date, CAST(Close AS DOUBLE) AS Close,
           CASE WHEN day(CAST(Date AS DATE)) % 2 = 0 THEN 'even' ELSE 'odd' END AS Batch
    FROM flatset"""))
def delivery_replay(spark, folder):
    """Even days only landed when the load stopped; the load of the odd days, of the same symbols, brings both."""
    bars = stored_bars(spark, folder)
    lake = Lake(spark, scratch_path(spark, "lake"), own_name("replay"))
    lake.create()
    days = {name: accept(market.responses_of(bars)).withColumn("values", F.filter(
        "values", lambda v: F.dayofmonth(v["datetime"].cast("date")) % 2 == odd)).withColumn("status", F.lit("ok"))
        for odd, name in ((0, "even"), (1, "odd"))}
    lake.land(days["even"].drop("symbol"), BatchContext("even", datetime(2024, 1, 1)))
    lake.land(days["odd"].drop("symbol"), BatchContext("odd", datetime(2024, 1, 2)))
    lake.replay()
    return lake.table("silver").select(
        "Symbol", "Date", F.col("Close").cast("double").alias("Close"), F.col("__CreatedBatchLogId").alias("Batch"))


# -- merges and measures that leave stored rows alone ---------------------------------------

@query("bucket_merge", with_ctes(f"""
    SELECT Symbol, Date, {PRICES_SQL}, __CurrentFlag, __EffectiveStartDateTime, __EffectiveEndDateTime,
           __lastmodified, __HashKey, __HashValue, __CreatedBatchLogId, __UpdatedBatchLogId, __UpdateDateTime
    FROM silver_merged"""))
def bucket_merge(spark, folder):
    """The second delivery merged into silver stored in buckets of its key."""
    rows, name = stored_bars(spark, folder), own_name("silver")
    buckets.create_bucketed(silver_of(rows), name, scratch_path(spark, "buckets"), SILVER_SPEC.key_hash, 8)
    buckets.merge_buckets(spark, name, silver_again(rows), SILVER_SPEC, BATCH_2, scratch_path(spark, "buckets"))
    return as_doubles(spark.table(name).select(
        "Symbol", "Date", *facts.PRICE_COLUMNS, "__CurrentFlag", "__EffectiveStartDateTime",
        "__EffectiveEndDateTime", "__lastmodified", "__HashKey", "__HashValue", "__CreatedBatchLogId",
        "__UpdatedBatchLogId", "__UpdateDateTime"))


def kept_states(spark, folder):
    """States by industry of the bars; those of 1997 and later are made anew from corrected bars."""
    star = stored(market.industry_star(spark, folder), "star")
    name, path = own_name("states"), scratch_path(spark, "states")
    sinks.create_table(spark, name, states.state_ddl(["Industry"]), f"{path}/empty", partition_by="Month")
    later = market.corrected_bars(star).filter(F.year("Date") >= 1997)
    for rows, folder_of in ((star, "first"), (later, "second")):
        made = states.month_states(rows, ["Industry"])
        months = [row[0] for row in made.select("Month").distinct().collect()]  # the calendar's months
        sinks.replace_partitions(spark, name, made, "Month", months, f"{path}/{folder_of}", ["Industry"])
    return spark.table(name)


RENEWED_SQL = {"istar": """
    SELECT b.*, Sort, Industry, Logo FROM (
      SELECT * FROM bars WHERE year(Date) < 1997
      UNION ALL SELECT * FROM corrected WHERE year(Date) >= 1997
      UNION ALL SELECT * FROM bars WHERE year(Date) >= 1997 AND CAST(date_trunc('month', Date) AS DATE) NOT IN (
        SELECT CAST(date_trunc('month', Date) AS DATE) FROM corrected)) b LEFT JOIN lookup USING (Symbol)"""}


@query("growth_from_states", with_ctes(
    "SELECT Industry, RangeName, fd AS FirstTradingDate, round(g, 6) AS Growth FROM growth_ind", **RENEWED_SQL))
def growth_from_states(spark, folder):
    grown = states.growth_from_states(kept_states(spark, folder), ["Industry"])
    return rounded(grown.select("Industry", "RangeName", "FirstTradingDate", "Growth"), "Growth")


@query("sums_from_states", with_ctes("""
    SELECT Industry, RangeName, CAST(sum(so) AS DOUBLE) AS SumOpen, CAST(sum(sc) AS DOUBLE) AS SumClose,
           CAST(min(lo) AS DOUBLE) AS MinLow, CAST(max(hi) AS DOUBLE) AS MaxHigh,
           round(CAST(sum(sv) AS DOUBLE) / CAST(sum(cv) AS DOUBLE), 6) AS AvgVolume
    FROM inrange_ind GROUP BY Industry, RangeName""", **RENEWED_SQL))
def sums_from_states(spark, folder):
    return rounded(states.sums_from_states(kept_states(spark, folder), ["Industry"]).drop("SortOrder"), "AvgVolume")


# -- ranges that stand in a table -----------------------------------------------------------

RANGES_SQL = """
    SELECT o_orderpriority || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS RangeName,
           CASE WHEN year(min(o_orderdate)) > 1995 THEN CAST(min(o_orderdate) AS DATE) END AS StartDate,
           CASE WHEN o_orderpriority NOT LIKE '1%' THEN CAST(max(o_orderdate) AS DATE) END AS EndDate
    FROM orders GROUP BY o_orderpriority, year(o_orderdate)"""


def order_ranges(spark, folder):
    """First to last order of every priority and year; some ranges are open at one end."""
    orders = market.table(spark, folder, "orders").select("o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    spans = orders.groupBy("o_orderpriority", F.year("day").alias("year")).agg(
        F.min("day").alias("low"), F.max("day").alias("high"))
    return spans.select(
        F.concat_ws(" ", "o_orderpriority", F.col("year").cast("string")).alias("RangeName"),
        F.when(F.year("low") > 1995, F.col("low")).alias("StartDate"),
        F.when(~F.col("o_orderpriority").startswith("1"), F.col("high")).alias("EndDate"))


TABLE_RANGES_SQL = """
    SELECT Symbol, RangeName, FirstTradingDate, LastTradingDate, CAST(fc AS DOUBLE) AS FirstClose,
           CAST(lc AS DOUBLE) AS LastClose, CAST(lo AS DOUBLE) AS MinLow, CAST(hi AS DOUBLE) AS MaxHigh, SumVolume, Days,
           round((CAST(lc AS DOUBLE) - CAST(fc AS DOUBLE)) / nullif(CAST(fc AS DOUBLE), 0), 6) AS Growth
    FROM (SELECT Symbol, RangeName, min(Date) FILTER (so > 0) AS FirstTradingDate, max(Date) FILTER (sc > 0) AS LastTradingDate,
                 arg_min(sc, Date) FILTER (so > 0) AS fc, arg_max(sc, Date) FILTER (sc > 0) AS lc,
                 min(lo) AS lo, max(hi) AS hi, CAST(sum(sv) AS BIGINT) AS SumVolume, count(*) AS Days
          FROM days_sym JOIN chosen_spans
            ON Date >= coalesce(StartDate, DATE '1900-01-01') AND Date <= coalesce(EndDate, DATE '2900-01-01')
          GROUP BY Symbol, RangeName)"""


@query("range_table_measures", with_ctes(TABLE_RANGES_SQL, chosen_spans=RANGES_SQL))
def range_table_measures(spark, folder):
    found = ranges.measures_in_ranges(stored_bars(spark, folder), order_ranges(spark, folder), ["Symbol"])
    return rounded(as_doubles(found.drop("StartDate", "EndDate")), "Growth")


@query("range_table_selected", with_ctes(TABLE_RANGES_SQL, spans=RANGES_SQL, chosen_spans="""
    SELECT * FROM spans WHERE RangeName IN (SELECT o_orderpriority || ' 1997' FROM orders GROUP BY o_orderpriority)"""))
def range_table_selected(spark, folder):
    """The ranges a slicer chose drive the measures."""
    known = order_ranges(spark, folder)
    priorities = market.table(spark, folder, "orders").select(
        F.concat("o_orderpriority", F.lit(" 1997")).alias("RangeName")).distinct()
    chosen = ranges.chosen_ranges(known, priorities, "1-URGENT 1996")
    found = ranges.measures_in_ranges(stored_bars(spark, folder), chosen, ["Symbol"])
    return rounded(as_doubles(found.drop("StartDate", "EndDate")), "Growth")


# -- sampling a chart -----------------------------------------------------------------------

CHART = {"points": 1200, "least": 100, "most": 1100, "most_series": 12}
CHART_SQL = f"""
    SELECT DISTINCT Symbol, Date, CAST(so AS DOUBLE) AS SumOpen, CAST(hi AS DOUBLE) AS MaxHigh FROM (
      SELECT *, row_number() OVER (PARTITION BY Symbol, bin ORDER BY so, Date) AS a,
             row_number() OVER (PARTITION BY Symbol, bin ORDER BY so DESC, Date) AS b,
             row_number() OVER (PARTITION BY Symbol, bin ORDER BY hi, Date) AS c,
             row_number() OVER (PARTITION BY Symbol, bin ORDER BY hi DESC, Date) AS d,
             row_number() OVER (PARTITION BY Symbol ORDER BY Date) AS e,
             row_number() OVER (PARTITION BY Symbol ORDER BY Date DESC) AS f
      FROM (SELECT *, least(floor(CAST(Date - d0 AS DOUBLE) / nullif(CAST(d1 - d0 AS DOUBLE), 0) * bins), bins - 1) AS bin
            FROM shown_days, chart_size WHERE true))
    WHERE n <= share OR 1 IN (a, b, c, d, e, f)"""
CHART_CTES = {
    "shown_names": f"SELECT Symbol FROM bars GROUP BY Symbol ORDER BY Symbol LIMIT {CHART['most_series']}",
    "shown_days": "SELECT *, count(*) OVER (PARTITION BY Symbol) AS n FROM days_sym WHERE Symbol IN (FROM shown_names)",
    "chart_share": f"""
        SELECT least({CHART['most']} // count(*), greatest({CHART['points']} // count(*), {CHART['least']})) AS share FROM shown_names""",
    "chart_size": """
        SELECT share, greatest((share - 2) // 4, 1) AS bins, (SELECT min(Date) FROM shown_days) AS d0,
               (SELECT max(Date) FROM shown_days) AS d1 FROM chart_share"""}


@query("sample_axis", with_ctes(CHART_SQL, **CHART_CTES))
def sample_axis(spark, folder):
    """Two measures of more symbols than are shown, under a budget of points for all of them."""
    days = m.daily(stored_bars(spark, folder), ["Symbol"]).select("Symbol", "Date", "SumOpen", "MaxHigh")
    return as_doubles(series.sample_axis(stored(days, "days"), "Date", ["SumOpen", "MaxHigh"], "Symbol", **CHART))


# -- upkeep ---------------------------------------------------------------------------------

@query("compact_appends", with_ctes("""
    SELECT Symbol, Date, CAST(Close AS DOUBLE) AS Close, true AS OneFileEach FROM bars"""))
def compact_appends(spark, folder):
    """A delivery for every year, appended to hashed folders, then packed."""
    rows, name, path = stored_bars(spark, folder), own_name("appended"), scratch_path(spark, "appended")
    sinks.create_table(spark, name, "Symbol STRING, Date DATE, Close DECIMAL(18,3), Bucket INT", f"{path}/first",
                       partition_by="Bucket")
    narrow = rows.select("Symbol", "Date", "Close")
    years = [row[0] for row in rows.select(F.year("Date")).distinct().collect()]  # the calendar's years
    for year in sorted(years):
        upkeep.append_hashed(narrow.filter(F.year("Date") == year), name, "Symbol", 4)
    upkeep.compact(spark, name, "Bucket", f"{path}/packed", sort_by=("Symbol", "Date"))
    files = upkeep.files_of(spark, name, "Bucket").groupBy("Bucket").agg(F.count(F.lit(1)).alias("n"))
    packed = files.agg(F.max("n")).scalar() == 1
    return as_doubles(spark.table(name).select("Symbol", "Date", "Close", packed.alias("OneFileEach")))


@query("sweep_loads", with_ctes("""
    SELECT Symbol, CAST(Date AS DATE) AS Date, CAST(Close AS DOUBLE) AS Close, true AS OnlyLiveFolders
    FROM (SELECT * FROM flat3 WHERE year(CAST(Date AS DATE)) <> 1997)""",
    flat3="SELECT * FROM flatset"))
def sweep_loads(spark, folder):
    """A table replaced twice month by month; the folders of the first two loads go, the rows stay."""
    bars = stored_bars(spark, folder)
    path, name = scratch_path(spark, "swept"), own_name("swept")
    flat = stored(market.responses_of(bars), "responses")
    rows = accept(flat).select(F.col("meta")["symbol"].alias("Symbol"), F.explode("values").alias("v")).select(
        "Symbol", F.col("v")["datetime"].cast("date").alias("Date"), F.col("v")["close"].cast("double").alias("Close")) \
        .distinct().withColumn("Year", F.year("Date"))
    sinks.create_table(spark, name, "Symbol STRING, Date DATE, Close DOUBLE, Year INT", f"{path}/empty", partition_by="Year")
    years = [row[0] for row in rows.select("Year").distinct().collect()]  # the calendar's years
    for load in ("one", "two", "three"):
        kept = rows.filter("Year <> 1997") if load == "three" else rows
        sinks.replace_partitions(spark, name, kept, "Year", years, f"{path}/{load}")
    upkeep.sweep(spark, [path], upkeep.live_locations(spark, [name]), datetime.now(timezone.utc) + timedelta(hours=1))
    later = datetime.now(timezone.utc) + timedelta(days=1)
    left = {place.rsplit("/", 1)[1] for place in upkeep.older_folders(spark, path, later)}
    return spark.table(name).select("Symbol", "Date", "Close", F.lit(left <= {"three", "empty"}).alias("OnlyLiveFolders"))
