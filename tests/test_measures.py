"""Time ranges, measures, sampling."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from candlelake.functions.dates import range_start
from candlelake.functions.values import growth_text, investment_growth, ratio
from candlelake.operators import measures as m
from candlelake.operators.series import downsample_minmax
from candlelake.plans import market, report

DDL = "Symbol string, Date date, Open decimal(18,3), High decimal(18,3), Low decimal(18,3), Close decimal(18,3), Volume long"


def star(spark, *rows):
    from decimal import Decimal
    return spark.createDataFrame(
        [(s, d, *(None if p is None else Decimal(p) for p in (o, c, o, c)), 10) for s, d, o, c in rows], DDL)


def one(spark, column):
    return spark.range(1).select(column).head()[0]


@pytest.mark.parametrize("name, start", [
    ("30 Days", date(2024, 1, 30)), ("90 Days", date(2023, 12, 1)), ("YTD", date(2024, 1, 1)),
    ("1Y", date(2023, 3, 1)), ("5Y", date(2019, 3, 1)), ("MAX", None)])
def test_range_start_on_a_leap_day(spark, name, start):
    assert one(spark, range_start(name, F.lit(date(2024, 2, 29)))) == start


def test_unknown_range():
    with pytest.raises(ValueError, match="unknown range"):
        range_start("2Y", None)


def test_growth_uses_the_first_close_and_both_ends(spark):
    rows = star(spark, ("A", date(2024, 1, 1), 1, 10), ("A", date(2024, 1, 31), 7, 20), ("A", date(2024, 2, 29), 8, 30),
                ("A", date(2024, 3, 1), 9, 40), ("A", date(2024, 3, 2), 9, 0))
    got = {r.RangeName: r for r in m.growth_by_range(rows, ["Symbol"]).collect()}
    days = got["30 Days"]
    # the last date has no close, so the range is anchored one day earlier
    assert days.LastTradingDate == date(2024, 3, 1) and days.RangeStart == date(2024, 1, 31)
    assert days.FirstTradingDate == date(2024, 1, 31)
    assert (float(days.FirstClose), float(days.LastClose), days.Growth) == (20.0, 40.0, 1.0)
    assert got["MAX"].Growth == 3.0 and got["MAX"].RangeStart is None


def test_single_day_zero_close_and_no_data(spark):
    rows = star(spark, ("ONE", date(2024, 1, 1), 5, 10), ("ZERO", date(2024, 1, 1), 5, 0),
                ("NONE", date(2024, 1, 1), None, None))
    got = {r.Symbol: r for r in report.symbol_cards(rows).collect()}
    assert got["ONE"].GrowthText == "0.00%" and got["ONE"].Color == "#039520"
    for blank in ("ZERO", "NONE"):
        assert (got[blank].LastClose, got[blank].GrowthText, got[blank].Color) == (None, "", "#039520")


def test_groups_share_one_anchor_but_average_growth_does_not(spark):
    rows = star(spark, ("A", date(2024, 1, 1), 1, 100), ("A", date(2024, 1, 10), 1, 200),
                ("B", date(2024, 1, 1), 1, 100), ("B", date(2024, 1, 5), 1, 50)).withColumn("Industry", F.lit("I"))
    total = m.growth_by_range(rows, ["Industry"], ["30 Days"]).head()
    assert (float(total.FirstClose), float(total.LastClose)) == (200.0, 200.0)
    mean = m.average_growth(rows, ["Industry"], ["30 Days"]).head()
    assert mean.AvgGrowth == pytest.approx((1.0 - 0.5) / 2)


def test_trend_is_green_or_red_never_both(spark):
    rows = star(spark, ("UP", date(2024, 1, 1), 1, 1), ("UP", date(2024, 1, 2), 1, 2),
                ("DOWN", date(2024, 1, 1), 1, 2), ("DOWN", date(2024, 1, 2), 1, 1))
    for r in report.sparklines(rows).collect():
        assert (r.Green is None) == (r.Symbol == "DOWN") and (r.Red is None) == (r.Symbol == "UP")
    months = report.month_report(rows, ["Symbol"]).collect()
    assert {(r.Symbol, r.YearMonthDate, r.Green, r.Red) for r in months} == {
        ("UP", date(2024, 1, 1), 3.0, None), ("DOWN", date(2024, 1, 1), None, 3.0)}


def test_range_filter_restricts_any_measure(spark):
    rows = star(spark, ("A", date(2023, 1, 1), 1, 1), ("A", date(2024, 1, 1), 2, 2), ("A", date(2024, 1, 2), 4, 4))
    inside = m.in_time_range(m.daily(rows, ["Symbol"]), ["Symbol"], "YTD")
    assert m.reaggregate(inside, ["Symbol"]).head()["SumOpen"] == 6.0


def test_text_and_ratio(spark):
    for value, text in ((0.12345, "+12.35%"), (-0.5, "-50.00%"), (0.00001, "0.00%"), (None, "")):
        assert one(spark, growth_text(F.lit(value).cast("double"))) == text
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, investment_growth(F.lit(None).cast("double"))) == 10000.0


def test_selected_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, None), (4, "a"), (4, None)], "k int, v string")
    got = m.selected_value(df, "v", ["k"], "-").collect()
    assert {r.k: r.v for r in got} == {1: "a", 2: "-", 3: None, 4: "-"}


def test_selected_range_and_slicers(spark):
    ranges = m.with_range_bounds(spark.createDataFrame([(date(2024, 1, 1),)], "LastTradingDate date"))
    assert report.selected_range(ranges).head()[0] == "30 Days"
    assert report.selected_range(ranges.filter("RangeName = 'YTD'")).head()[0] == "YTD"
    marked = report.range_slicer(ranges, "YTD").collect()
    assert [r.RangeName for r in marked if r.IsDefault] == ["YTD"] and marked[0].RangeName == "30 Days"


def test_summary_keeps_days_with_the_required_measure(spark):
    rows = star(spark, ("A", date(2024, 1, 1), None, 5), ("A", date(2024, 1, 2), 3, 5))
    assert [r.Date for r in report.summarize_series(rows).collect()] == [date(2024, 1, 2)]


def brute(points, limit):
    """Reference sampling of one series: {day: value}."""
    if len(points) <= limit:
        return set(points)
    days = sorted(points)
    bins = (limit - 2) // 2
    kept, groups = {days[0], days[-1]}, {}
    span = (days[-1] - days[0]).days + 1
    for day in days[1:-1]:
        groups.setdefault((day - days[0]).days * bins // span, []).append(day)
    for group in groups.values():
        kept.add(min(group, key=lambda d: (points[d], d)))
        kept.add(min(group, key=lambda d: (-points[d], d)))
    return kept


@pytest.mark.parametrize("limit", [4, 10, 51, 500])
def test_downsampling(spark, limit):
    import random
    rng = random.Random(limit)
    series = {name: {date(2020, 1, 1) + timedelta(days=d): rng.randint(1, 20)
                     for d in rng.sample(range(900), size)} for name, size in (("long", 400), ("short", 7))}
    df = spark.createDataFrame([(n, d, v) for n, p in series.items() for d, v in p.items()], "s string, d date, v int")
    got = {}
    for row in downsample_minmax(df, ["s"], "d", "v", limit).collect():
        got.setdefault(row.s, []).append((row.d, row.v))
    for name, points in series.items():
        assert sorted(got[name]) == sorted((d, points[d]) for d in brute(points, limit))
        assert len(got[name]) <= limit


def test_downsampling_keeps_other_columns(spark):
    df = spark.createDataFrame([("s", date(2020, 1, d), d, f"x{d}") for d in range(1, 21)],
                               "s string, d date, v int, note string")
    out = downsample_minmax(df, ["s"], "d", "v", 6)
    assert out.columns == df.columns and all(r.note == f"x{r.v}" for r in out.collect())


def test_downsampling_skips_blanks_and_knows_other_axes(spark):
    days = spark.createDataFrame(
        [("A", date(2024, 1, 1 + i), None if i % 4 == 0 else float(i % 7)) for i in range(28)], "s string, d date, v double")
    got = downsample_minmax(days, ["s"], "d", "v", 8).collect()
    assert 2 <= len(got) <= 8 and all(r.v is not None for r in got)
    assert {min(r.v for r in got), max(r.v for r in got)} == {0.0, 6.0}
    hours = spark.createDataFrame([(None, datetime(2024, 1, 1, i), float(i)) for i in range(10)], "s string, d timestamp, v double")
    assert downsample_minmax(hours, ["s"], "d", "v", 100).count() == 10
    assert sorted(r.d.hour for r in downsample_minmax(hours, ["s"], "d", "v", 6).collect())[::5][:1] == [0]
    numbers = spark.createDataFrame([("A", float(i), float((i * 37) % 101)) for i in range(500)], "s string, d double, v double")
    out = downsample_minmax(numbers, ["s"], "d", "v", 50).collect()
    assert len(out) <= 50 and {0.0, 499.0} <= {r.d for r in out}


def lines_table(spark, tmp_path, rows):
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double,"
                                " l_quantity double, l_shipdate date").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 7), (2, 7)], "s_suppkey long, s_nationkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    return str(tmp_path)


def test_trades_follow_all_five_fields(spark, tmp_path):
    day = date(2024, 1, 2)
    folder = lines_table(spark, tmp_path, [
        (10**12, 2, 1, 1, 250_000.0, 1.0, day), (10**12, 1, 9, 1, -30.0, 1.0, day), (10**12, 1, 9, 1, -40.0, 1.0, day),
        (6 * 10**18, 3, 5, 1, 70.0, 1.0, day), (6 * 10**18, 3, 5, 2, 60.0, 1.0, day), (5, 1, 1, 2, 10.0, 1.0, date(2024, 1, 3))])
    bars = {r.Date: r for r in market.daily_by_nation(spark, folder).collect()}
    assert tuple(map(float, (bars[day].Open, bars[day].Close, bars[day].High, bars[day].Low))) == (-4.0, 6.0, 25_000.0, -4.0)
    assert float(bars[date(2024, 1, 3)].Open) == float(bars[date(2024, 1, 3)].Close) == 1.0
