"""Stored tables over several loads, in batches and as a stream."""

import json
from datetime import date, datetime

import pytest
from pyspark.errors import SparkRuntimeException

from candlelake import schemas
from candlelake.context import BatchContext
from candlelake.plans import report
from candlelake.plans.lake import Lake
from candlelake.session import scratch_path
from candlelake.sources import responses
from candlelake.streaming.landing import load_available


def document(symbol, closes, status="ok"):
    values = [{"datetime": day, "open": "1", "high": "9", "low": "1", "close": str(close), "volume": "5"}
              for day, close in closes.items()]
    meta = {"symbol": symbol, "exchange": "X", "currency": "USD", "type": "Common Stock", "exchange_timezone": "UTC"}
    return {"meta": meta, "values": values, "status": status}


def land(path, name, *docs):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(doc) for doc in docs))
    return str(path)


@pytest.fixture
def lake(spark, request, first):
    prefix = "t_" + request.node.name.replace("[", "_").replace("]", "")
    lake = Lake(spark, scratch_path(spark, "lake"), prefix)
    lake.create(replace=True)
    lake.seed_lookup(spark.createDataFrame([(1, "Tech", "A", "a.svg"), (2, "Tech", "B", "b.svg")],
                                           schemas.SYMBOL_LOOKUP), first)
    return lake


def facts_of(lake):
    rows = lake.star().select("Symbol", "DateID", "Close", "TransactionSID").collect()
    return {(r.Symbol, r.DateID): (float(r.Close), r.TransactionSID) for r in rows}


def test_loads(spark, lake, tmp_path):
    landed = responses.read_landed(spark, land(
        tmp_path / "one", "a.json", document("A", {"2024-01-30": 1, "2024-02-01": 2}), document("B", {"2024-01-30": 3}),
        document("C", {"2024-01-30": 4}), document("D", {"2024-01-30": 4}, "error")))
    lake.load(landed, BatchContext("b1", datetime(2024, 2, 2)))
    one = facts_of(lake)
    assert {k: v[0] for k, v in one.items()} == {
        ("A", 20240130): 1, ("A", 20240201): 2, ("B", 20240130): 3, (None, 20240130): 4}
    assert lake.table("dim_date").count() == 366 * 7 + 365 * 18  # 2000-01-01 to 2024-12-31
    assert lake.table("dim_symbol").count() == 2

    # the same again: nothing moves
    files = {kind: set(lake.table(kind).inputFiles()) for kind in ("silver", "fact_daily")}
    lake.load(landed, BatchContext("b2", datetime(2024, 2, 3)))
    assert facts_of(lake) == one
    assert files == {kind: set(lake.table(kind).inputFiles()) for kind in files}
    assert lake.table("silver").count() == 4

    # a corrected and a new day in February only; January keeps its files and its facts
    later = responses.read_landed(spark, land(
        tmp_path / "two", "a.json", document("A", {"2024-02-01": 7, "2024-02-02": 8})))
    january = set(lake.table("fact_daily").filter("Month = 202401").inputFiles())
    lake.load(later, BatchContext("b3", datetime(2024, 3, 1)))
    three = facts_of(lake)
    assert {k: v[0] for k, v in three.items()} == {
        ("A", 20240130): 1, ("A", 20240201): 7, ("A", 20240202): 8, ("B", 20240130): 3, (None, 20240130): 4}
    assert three[("A", 20240130)] == one[("A", 20240130)]
    assert three[("A", 20240201)][1] > max(v[1] for v in one.values())
    assert len({v[1] for v in three.values()}) == len(three)
    assert set(lake.table("fact_daily").filter("Month = 202401").inputFiles()) == january
    versions = lake.table("silver").filter("Symbol = 'A' and Date = '2024-02-01'").orderBy("__EffectiveStartDateTime")
    assert [(float(r.Close), r["__CurrentFlag"]) for r in versions.collect()] == [(2.0, False), (7.0, True)]
    cards = {r.Symbol: r for r in report.symbol_cards(lake.star()).collect()}
    assert cards["A"].LastClose == 8.0 and cards["A"].GrowthText == "+700.00%"


def test_changed_symbol_attribute_opens_a_version(spark, lake, tmp_path):
    doc = document("A", {"2024-01-30": 1})
    lake.load(responses.read_landed(spark, land(tmp_path / "one", "a.json", doc)),
              BatchContext("b1", datetime(2024, 2, 1)))
    doc["meta"]["type"] = "Preferred"
    lake.load(responses.read_landed(spark, land(tmp_path / "two", "a.json", doc)),
              BatchContext("b2", datetime(2024, 2, 2)))
    dim = lake.table("dim_symbol").orderBy("SymbolSID").collect()
    assert [(r.Type, r["__CurrentFlag"]) for r in dim] == [("Common Stock", False), ("Preferred", True)]
    assert [r.SymbolSID for r in lake.table("fact_daily").collect()] == [dim[1].SymbolSID]


def loaded(spark, lake, path, name, when, *docs):
    lake.load(responses.read_landed(spark, land(path / name, "a.json", *docs)), BatchContext(name, when))


def test_interrupted_load_reaches_gold_however_much_later(spark, lake, tmp_path, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(Lake, "load_dim_symbol", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loaded(spark, lake, tmp_path, "one", datetime(2024, 1, 2), document("A", {"2024-01-01": 1}))
    assert lake.table("silver").count() == 1 and lake.table("fact_daily").count() == 0
    loaded(spark, lake, tmp_path, "two", datetime(2024, 3, 2), document("A", {"2024-03-01": 3}))
    assert {k: v[0] for k, v in facts_of(lake).items()} == {("A", 20240101): 1, ("A", 20240301): 3}


def test_symbol_added_to_the_lookup_later_reaches_old_facts(spark, lake, tmp_path):
    loaded(spark, lake, tmp_path, "one", datetime(2024, 1, 3), document("C", {"2024-01-02": 1}))
    assert set(facts_of(lake)) == {(None, 20240102)}
    lookup = spark.createDataFrame([(1, "Tech", "A", "a.svg"), (3, "Oil", "C", "c.svg")], schemas.SYMBOL_LOOKUP)
    lake.seed_lookup(lookup, BatchContext("seed", datetime(2024, 5, 1)))
    loaded(spark, lake, tmp_path, "two", datetime(2024, 5, 3), document("A", {"2024-05-02": 2}))
    assert set(facts_of(lake)) == {("C", 20240102), ("A", 20240502)}
    assert lake.table("fact_daily").count() == 2


def test_rows_without_date_are_set_aside(spark, lake, tmp_path):
    doc = document("A", {"2024-01-02": 1})
    doc["values"].append({**doc["values"][0], "datetime": None})
    loaded(spark, lake, tmp_path, "one", datetime(2024, 1, 3), doc)
    assert lake.table("silver").count() == 1
    assert spark.read.json(lake.path("rejected_bars", "one")).count() == 1


def test_calendar_covers_data_before_its_origin(spark, lake, tmp_path):
    loaded(spark, lake, tmp_path, "one", datetime(2000, 1, 9), document("A", {"2000-01-05": 4}))
    loaded(spark, lake, tmp_path, "two", datetime(2000, 1, 10), document("A", {"1999-12-30": 1}))
    assert lake.table("dim_date").agg({"Date": "min"}).head()[0] == date(1999, 1, 1)
    assert lake.table("dim_date").count() == lake.table("dim_date").select("Date").distinct().count() == 731
    cards = report.symbol_cards(lake.star(), "1Y").collect()
    assert [(r.Symbol, r.GrowthText) for r in cards] == [("A", "+300.00%")]


def test_one_candidate_per_symbol_and_history_under_closed_versions(spark, lake, tmp_path):
    loaded(spark, lake, tmp_path, "one", datetime(2024, 1, 3), document("A", {"2023-06-01": 1, "2024-01-02": 1}))
    doc = document("A", {"2024-01-08": 2})
    doc["meta"]["type"] = "ETF"
    loaded(spark, lake, tmp_path, "two", datetime(2024, 1, 9), document("A", {"2024-01-07": 2}), doc)
    versions = lake.table("dim_symbol").orderBy("SymbolSID").collect()
    assert [(r.Type, r["__CurrentFlag"]) for r in versions] == [("Common Stock", False), ("ETF", True)]
    assert sorted(k for k in facts_of(lake)) == [("A", 20230601), ("A", 20240102), ("A", 20240107), ("A", 20240108)]
    assert lake.table("fact_daily").count() == 4
    assert {r.Type for r in lake.star().collect()} == {"ETF"}
    assert report.symbol_cards(lake.star(), "1Y").head().GrowthText == "+100.00%"


def test_ids_are_reserved_before_they_are_published(spark, lake, tmp_path, monkeypatch):
    loaded(spark, lake, tmp_path, "one", datetime(2024, 1, 3), document("A", {"2024-01-02": 1}))
    with monkeypatch.context() as patch:
        patch.setattr(Lake, "load_dim_date", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loaded(spark, lake, tmp_path, "two", datetime(2024, 2, 3), document("A", {"2024-02-02": 2}))
    top = lake._top_id()
    assert top >= max(v[1] for v in facts_of(lake).values())
    loaded(spark, lake, tmp_path, "three", datetime(2024, 3, 3), document("B", {"2024-03-02": 3}))
    ids = [v[1] for v in facts_of(lake).values()]
    assert len(set(ids)) == len(ids) == 3 and sum(i > top for i in ids) == 1


def test_broken_and_indented_documents(spark, tmp_path):
    good, broken = json.dumps(document("A", {"2024-01-02": 1})), '{"meta": {"symbol": "B"'
    path = land(tmp_path / "in", "a.json")
    (tmp_path / "in" / "a.json").write_text(good + "\n" + broken + "\n")
    landed = responses.read_landed(spark, path)
    assert responses.accept(landed).count() == 1
    assert [r["_corrupt_record"] for r in responses.reject(landed).collect()] == [broken]
    whole = tmp_path / "whole"
    whole.mkdir()
    (whole / "a.json").write_text(json.dumps(document("A", {"2024-01-02": 1}), indent=2))
    assert responses.accept(responses.read_landed(spark, str(whole), multi_line=True)).count() == 1


def test_intraday_values_do_not_become_daily_facts(spark, lake, tmp_path):
    doc = document("A", {"2024-01-30 10:00:00": 1, "2024-01-30 11:00:00": 2})
    landed = responses.read_landed(spark, land(tmp_path / "one", "a.json", doc))
    with pytest.raises(SparkRuntimeException, match="2 rows for key"):
        lake.load(landed, BatchContext("b1", datetime(2024, 2, 1)))
    assert lake.table("silver").count() == 2 and lake.table("fact_daily").count() == 0


def test_failed_response_batch_changes_nothing(spark, lake, tmp_path):
    landed = responses.read_landed(spark, land(tmp_path / "one", "a.json", document("A", {"2024-01-30": 1}, "error")))
    lake.load(landed, BatchContext("b1", datetime(2024, 2, 1)))
    assert all(lake.table(kind).count() == 0 for kind in ("silver", "dim_symbol", "dim_date", "fact_daily"))
    assert spark.read.json(lake.path("rejected", "b1")).count() == 1


def test_stream_loads_each_file_once(spark, lake, tmp_path):
    path = land(tmp_path / "in", "a.json", document("A", {"2024-01-30": 1}))
    checkpoint = str(tmp_path / "checkpoint")
    clock = iter(datetime(2024, 2, day) for day in range(1, 9)).__next__

    def run():
        query = load_available(lake, path, checkpoint, clock)
        query.awaitTermination(300)
        return {(r.Symbol, r.Date): float(r.Close) for r in lake.table("silver").filter("__CurrentFlag").collect()}

    assert run() == {("A", date(2024, 1, 30)): 1}
    land(tmp_path / "in", "b.json", document("A", {"2024-01-30": 5, "2024-01-31": 6}), document("B", {"2024-01-31": 2}))
    assert run() == {("A", date(2024, 1, 30)): 5, ("A", date(2024, 1, 31)): 6, ("B", date(2024, 1, 31)): 2}
    assert run() == {("A", date(2024, 1, 30)): 5, ("A", date(2024, 1, 31)): 6, ("B", date(2024, 1, 31)): 2}
    assert lake.table("silver").count() == 4
