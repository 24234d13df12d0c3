"""Responses, conforming, calendar, requests, sinks."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from candlelake import schemas
from candlelake.context import BatchContext
from candlelake.operators import conform, dims, facts, flatten, sinks
from candlelake.plans import legacy
from candlelake.plans.silver import build_silver, flat_bars, rejected_bars
from candlelake.schemas import empty_table
from candlelake.queries.common import stored
from candlelake.session import scratch_path, shared_dir
from candlelake.sources import generated, responses, tables

META = {"symbol": "AAA", "exchange": "X", "currency": "USD", "type": "Common Stock", "exchange_timezone": "UTC"}
DAY = {"datetime": "2024-01-02", "open": "1.5", "high": "2", "low": "1", "close": "1.75", "volume": "100"}


def documents(spark, tmp_path, *docs):
    path = tmp_path / "landed"
    path.mkdir()
    (path / "docs.json").write_text("\n".join(json.dumps(doc) for doc in docs))
    return responses.read_landed(spark, str(path))


def test_acceptance(spark, tmp_path):
    landed = documents(
        spark, tmp_path,
        {"meta": META, "values": [DAY, DAY], "status": "ok"},
        {"meta": META, "values": [], "status": "ok"},
        {"meta": META, "values": None, "status": "ok"},
        {"meta": META, "values": [DAY], "status": "error"},
        {"values": [DAY], "status": "ok"},
        {"meta": META, "values": [DAY]},
        {"code": 429})
    assert responses.accept(landed).count() == 3
    assert responses.reject(landed).count() == 4
    assert flatten.flatten_responses(responses.accept(landed)).count() == 2
    row = flat_bars(landed).collect()
    assert len(row) == 1 and row[0]["Symbol"] == "AAA" and row[0]["Close"] == "1.75"


def test_empty_landing_folder(spark, tmp_path):
    (tmp_path / "none").mkdir()
    landed = responses.read_landed(spark, str(tmp_path / "none"))
    assert landed.count() == 0 and landed.columns == ["meta", "values", "status", "_corrupt_record"]


def test_bad_values_are_set_aside(spark, tmp_path, first):
    bad = {**DAY, "datetime": "2024-01-03", "close": "n/a"}
    landed = documents(spark, tmp_path, {"meta": META, "values": [DAY, bad], "status": "ok"})
    silver = build_silver(empty_table(spark, "silver"), landed, first)
    assert [tuple(row) for row in silver.select("Symbol", "Date", "Close").collect()] == [
        ("AAA", date(2024, 1, 2), silver.head()["Close"])]
    assert rejected_bars(flat_bars(landed)).head()["Close"] == "n/a"
    assert silver.schema == schemas.schema_of(schemas.SILVER)


def test_conform_adds_skips_and_casts(spark):
    df = spark.createDataFrame([("5", "x")], "a string, b string")
    out = conform.conform(df, "id BIGINT, A INT, c DATE", skip=("id",))
    assert out.columns == ["A", "c"] and tuple(out.head()) == (5, None)
    grown = conform.add_columns(df, "b STRING, Sort INT")
    assert grown.columns == ["a", "b", "Sort"] and grown.head()["Sort"] is None


def test_numeric_symbol_stays_text(spark, tmp_path):
    meta = {**META, "symbol": "0700"}
    landed = documents(spark, tmp_path, {"meta": meta, "values": [DAY], "status": "ok"})
    path = scratch_path(spark, "bronze")
    sinks.overwrite_partitions(responses.accept(landed), path)
    assert responses.read_bronze(spark, path).head()["meta"]["symbol"] == "0700"
    assert spark.read.schema(schemas.BRONZE).parquet(path).head()["symbol"] == "0700"


def test_partition_overwrite_leaves_others(spark):
    path = scratch_path(spark, "parts")
    ddl = "v int, symbol string"
    sinks.overwrite_partitions(spark.createDataFrame([(1, "a"), (1, "b")], ddl), path)
    sinks.overwrite_partitions(spark.createDataFrame([(2, "b")], ddl), path)
    stored = spark.read.schema(ddl).parquet(path)
    assert sorted(map(tuple, stored.collect())) == [(1, "a"), (2, "b")]
    sinks.append_by(spark.createDataFrame([(2, "b")], ddl), path)
    assert stored.sparkSession.read.schema(ddl).parquet(path).count() == 3


def test_schema_evolution(spark):
    path = scratch_path(spark, "evolving")
    sinks.append_evolving(spark.createDataFrame([(1,)], "a int"), path)
    sinks.append_evolving(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert sorted(map(tuple, sinks.read_evolving(spark, path).collect())) == [(1, None), (2, "x")]
    sinks.overwrite_evolving(spark.createDataFrame([(3, 4)], "a int, c int"), path)
    assert sinks.read_evolving(spark, path).columns == ["a", "c"]


def test_table_references_and_switch(spark):
    path = scratch_path(spark, "t")
    sinks.create_table(spark, "switched", "a INT", path, replace=True)
    assert sinks.empty_like(spark, spark.table("switched")).count() == 0
    for value in (1, 2):
        grown = spark.table("switched").union(spark.createDataFrame([(value,)], "a int"))
        sinks.switch_location(spark, "switched", grown, f"{path}-{value}")
    for ref in ("switched", f"{path}-2", f"parquet.`{path}-2`"):
        assert tables.read_table(spark, ref).count() == 2


def test_replaced_table_is_empty(spark):
    path = scratch_path(spark, "replaced")
    for _ in range(2):
        sinks.create_table(spark, "replaced", "a INT", path, replace=True)
        assert spark.table("replaced").count() == 0
        spark.createDataFrame([(1,), (2,)], "a int").write.insertInto("replaced")
    assert spark.table("replaced").count() == 2


def test_replace_partitions_only_touches_its_scope(spark):
    path = scratch_path(spark, "months")
    sinks.create_table(spark, "monthly", "v INT, m INT", path, replace=True, partition_by="m")
    def put(rows, scope, label):
        df = spark.createDataFrame(rows, "v int, m int")
        sinks.replace_partitions(spark, "monthly", df, "m", scope, f"{path}-{label}")
    put([(1, 1), (2, 2), (3, 3)], [1, 2, 3], "a")
    before = spark.table("monthly").filter("m = 2")
    sinks.replace_partitions(spark, "monthly", before.selectExpr("v + 10 as v", "m"), "m", [2, 3], f"{path}-b")
    assert sorted(map(tuple, spark.table("monthly").collect())) == [(1, 1), (12, 2)]


def test_changed_since(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 5)), (2, datetime(2024, 1, 5, 0, 0, 1))], "k int, at timestamp")
    assert [row.k for row in tables.changed_since(df, "at", date(2024, 1, 15)).collect()] == [2]


def test_requests(spark):
    symbols = spark.createDataFrame([(f"S{i}",) for i in range(12)] * 2, "symbol string")
    plan = generated.request_plan(symbols, date(2024, 1, 15), "1h").collect()
    assert sorted(row.batch_no for row in plan) == [1] * 5 + [2] * 5 + [3] * 2
    assert {(row.start_date, row.end_date) for row in plan} == {(date(2024, 1, 5), date(2024, 1, 16))}
    with pytest.raises(ValueError, match="no such interval"):
        generated.request_plan(symbols, date(2024, 1, 15), "5min")


def test_seeds(spark):
    lookup = generated.symbol_lookup(spark)
    assert lookup.count() == 10 and {r.Industry for r in lookup.collect()} == {
        "No Industry", "Tech", "Automotive", "Finance"}
    assert [r.RangeName for r in generated.time_ranges(spark).orderBy("SortOrder").collect()] == [
        "30 Days", "90 Days", "YTD", "1Y", "5Y", "MAX"]


def test_calendar_rows(spark):
    rows = dims.calendar(generated.spine_between(spark, "2024-02-28", "2024-03-01")).collect()
    assert [r.DateID for r in rows] == [20240228, 20240229, 20240301]
    leap = rows[1].asDict()
    assert (leap["DayOfWeek"], leap["DayOfWeekNumber"], leap["MonthName"], leap["YearMonth"]) == (
        "Thursday", 5, "Feb", 202402)
    first = dims.with_first_of_month(dims.calendar(generated.spine_between(spark, "2024-02-29", "2024-02-29")))
    assert first.head()["YearMonthDate"] == date(2024, 2, 1)


@pytest.mark.parametrize("newest, held, expected", [
    ("2001-05-05", None, (date(2000, 1, 1), date(2001, 12, 31), 731)),
    ("2001-05-05", "2000-12-31", (date(2000, 12, 30), date(2001, 12, 31), 367)),
    ("2000-06-01", "2000-12-31", (date(2000, 1, 1), date(2000, 12, 31), 366)),
    ("1999-03-01", None, (date(1999, 1, 1), date(1999, 12, 31), 365)),
    (None, "2000-12-31", (date(2000, 12, 30), date(2000, 12, 31), 2)),
    (None, None, (None, None, 0)),
])
def test_calendar_extension(spark, newest, held, expected):
    dim = empty_table(spark, "dim_date")
    if held:
        dim = dims.calendar(generated.spine_between(spark, "2000-12-30", held))
    data = spark.sql(f"select cast({repr(newest) if newest else 'null'} as date) as Date")
    grown = dims.extend_calendar(dim, data).agg(F.min("Date"), F.max("Date"), F.count("*")).head()
    assert tuple(grown) == expected


def test_open_dates_are_all_or_none(spark):
    dim = dims.calendar(generated.spine_between(spark, "2024-01-01", "2024-01-03"))
    for prices, days in (([0, 0], 0), ([0, 1], 3), ([], 0)):
        fact = spark.createDataFrame([(p,) for p in prices], "Open int")
        assert dims.open_dates(dim, fact).count() == days


def test_unknown_symbols_keep_their_facts(spark, first, second):
    """Two symbols missing from the dimension do not collide, and a re-run changes nothing."""
    silver = spark.createDataFrame(
        [(s, "X", "USD", "t", "z", 1, 1.0, 1.0, 1.0, 1.0, date(2024, 1, 2), True) for s in "ABC"],
        "Symbol string, ExchangeName string, Currency string, Type string, ExchangeTimeZone string, Volume long, "
        "High double, Low double, Close double, Open double, Date date, __CurrentFlag boolean")
    lookup = spark.createDataFrame([(1, "I", "A", "l")], schemas.SYMBOL_LOOKUP)
    dim = dims.build_dim_symbol(empty_table(spark, "dim_symbol"), silver, lookup, first)
    once = stored(facts.build_fact_daily(empty_table(spark, "fact_daily"), silver, dim, first), "fact")
    assert once.count() == 3 and once.filter("SymbolSID is null").count() == 2
    assert once.select("TransactionSID").distinct().count() == 3
    twice = facts.build_fact_daily(once, silver, dim, second)
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)


def test_symbol_candidates_ignore_outdated_attributes(spark):
    ddl = "Symbol string, ExchangeName string, Currency string, Type string, ExchangeTimeZone string, __CurrentFlag boolean"
    silver = spark.createDataFrame([("A", "X", "USD", "old", "z", False), ("A", "X", "USD", "new", "z", True)], ddl)
    lookup = spark.createDataFrame([(1, "I", "A", "l")], schemas.SYMBOL_LOOKUP)
    assert dims.symbol_candidates(silver, lookup).count() == 1
    assert dims.symbol_candidates(silver, lookup, strict=True).count() == 2


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_batch_defaults_are_usable():
    assert BatchContext().batch_id != BatchContext().batch_id


def test_calendar_updates_insert_new_days_only(spark):
    path = scratch_path(spark, "calendar")
    dims.update_calendar(spark, path, "2024-01-01", "2024-01-10")
    dims.update_calendar(spark, path, date(2024, 1, 5), date(2024, 1, 12))
    stored = spark.read.parquet(path)
    assert stored.count() == stored.select("Date").distinct().count() == 12


def test_older_layout(spark, tmp_path):
    landed = documents(spark, tmp_path, {"meta": META, "values": [DAY, {**DAY, "volume": "?"}], "status": "ok"},
                       {"meta": {**META, "symbol": "BBB"}, "values": [DAY], "status": "ok"})
    bronze, silver, gold = (scratch_path(spark, label) for label in ("b", "s", "g"))
    legacy.save_by_symbol(responses.accept(landed), bronze)
    legacy.bronze_to_silver(spark, bronze, silver, datetime(2024, 1, 1))
    for runs in (1, 2):
        legacy.silver_to_gold(spark, silver, gold)
        assert spark.read.parquet(f"{gold}/dim_stock").count() == 2
        prices = spark.read.parquet(f"{gold}/fact_stock_price")
        assert prices.count() == 3 * runs and prices.filter("volume is null").count() == runs
