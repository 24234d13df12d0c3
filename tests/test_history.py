"""Deliveries out of order, interrupted loads, and reads that only touch their months."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from test_lake import document, facts_of, lake, loaded  # noqa: F401

from candlelake import schemas
from candlelake.context import BatchContext, TableSpec
from candlelake.operators.audit import add_audit_columns
from candlelake.operators.history import fold_versions, splice_merge
from candlelake.operators import measures as m
from candlelake.operators import states
from candlelake.operators.merge import scd_merge
from candlelake.plans.lake import Lake
from candlelake.session import scratch_path

DIM = TableSpec("Dim", ("k",), ("t",))
STAGE = TableSpec("Stage", ("k",))


def batch(number):
    return BatchContext(f"b{number:02}", datetime(2024, 1, 1) + timedelta(days=number))


def observed(spark, spec, number, rows):
    ddl = "k INT, t INT, v STRING"
    df = add_audit_columns(spark.createDataFrame(rows, ddl), spec, batch(number))
    return df.drop("t") if spec is STAGE else df


def as_set(df):
    return sorted((tuple(str(row[c]) for c in sorted(df.columns)) for row in df.collect()))


def deliveries(seed, n=7):
    draw = random.Random(seed)
    return {number: [(k, draw.randint(0, 1), draw.choice("ab")) for k in range(6) if draw.random() < .8]
            for number in range(n)}


def ordered(spark, spec, found):
    target = observed(spark, spec, 0, []).limit(0)
    for number in sorted(found):
        target = spark.createDataFrame(scd_merge(target, observed(spark, spec, number, found[number]), spec,
                                                 batch(number)).collect(), target.schema)
    return target


@pytest.mark.parametrize("spec", [DIM, STAGE], ids=["dim", "stage"])
@pytest.mark.parametrize("seed", [1])
def test_fold_equals_ordered_merges(spark, spec, seed):
    found = deliveries(seed)
    rows = None
    for number in random.Random(seed).sample(sorted(found), len(found)):
        part = observed(spark, spec, number, found[number])
        rows = part if rows is None else rows.unionByName(part)
    assert as_set(fold_versions(rows, spec)) == as_set(ordered(spark, spec, found))


@pytest.mark.parametrize("spec", [DIM, STAGE], ids=["dim", "stage"])
def test_late_deliveries_equal_ordered_merges(spark, spec):
    """One delivery after the other is spliced in, in a random order, from the rows of those before it."""
    found = deliveries(11, 5)
    order = random.Random(5).sample(sorted(found), 5)
    target, kept = observed(spark, spec, 0, []).limit(0), None
    for number in order:
        source = observed(spark, spec, number, found[number])
        target = spark.createDataFrame(splice_merge(target, source, spec, kept).collect(), target.schema)
        kept = source if kept is None else kept.unionByName(source)
    assert as_set(target) == as_set(ordered(spark, spec, found))


def test_versions_older_than_the_kept_deliveries_stay(spark):
    found = {0: [(1, 0, "a")], 1: [(1, 0, "b")], 2: [(1, 0, "b")], 5: [(1, 0, "a")]}
    target = ordered(spark, STAGE, found)
    kept = observed(spark, STAGE, 2, found[2]).unionByName(observed(spark, STAGE, 5, found[5]))
    late = observed(spark, STAGE, 3, [(1, 0, "c")])
    want = ordered(spark, STAGE, {**found, 3: [(1, 0, "c")]})
    assert as_set(splice_merge(target, late, STAGE, kept)) == as_set(want)
    # without any of them the late value still gets a place between its neighbours
    spans = sorted((r.v, r["__EffectiveStartDateTime"], r["__EffectiveEndDateTime"], r["__CurrentFlag"])
                   for r in splice_merge(target, late, STAGE).collect())
    assert all(start < end for _, start, end, _ in spans) and [s[0] for s in spans if s[3]] == ["a"] and len(spans) == 4


def test_plain_merge_refuses_what_is_older_than_its_target(spark):
    target = ordered(spark, STAGE, {4: [(1, 0, "a")]})
    with pytest.raises(SparkRuntimeException, match="needs splice_merge"):
        scd_merge(target, observed(spark, STAGE, 2, [(1, 0, "b")]), STAGE, batch(2)).collect()
    same = scd_merge(target, observed(spark, STAGE, 2, [(1, 0, "a")]), STAGE, batch(2))
    assert as_set(same) == as_set(target)
    with pytest.raises(SparkRuntimeException, match="2 rows for key"):
        splice_merge(target, observed(spark, STAGE, 2, [(1, 0, "a"), (1, 0, "c")]), STAGE).collect()


# -- the stored lake ------------------------------------------------------------------------

def silver_of(lake):
    return sorted((r.Symbol, r.Date, float(r.Close), r["__EffectiveStartDateTime"], r["__EffectiveEndDateTime"],
                   r["__CurrentFlag"], r["__CreatedBatchLogId"]) for r in lake.table("silver").collect())


def test_delivery_before_silver_is_not_lost(spark, lake, tmp_path, monkeypatch):  # noqa: F811
    with monkeypatch.context() as patch:
        patch.setattr(Lake, "load_silver", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loaded(spark, lake, tmp_path, "one", datetime(2024, 1, 2), document("A", {"2024-01-01": 1}))
    assert lake.table("silver").count() == 0
    loaded(spark, lake, tmp_path, "two", datetime(2024, 1, 3), document("A", {"2024-01-02": 3}))
    assert {k: v[0] for k, v in facts_of(lake).items()} == {("A", 20240101): 1, ("A", 20240102): 3}
    assert [row[-1] for row in silver_of(lake)] == ["one", "two"]
    assert [sorted(d.paths) for d in lake.deliveries()] == [["gold", "landed", "silver"]] * 2


def test_load_stopped_inside_silver_is_finished(spark, lake, tmp_path, monkeypatch):  # noqa: F811
    """The merge is through but not noted: merging the same delivery again changes nothing."""
    note = Lake._note
    with monkeypatch.context() as patch:
        patch.setattr(Lake, "_note", lambda self, d, step, path=None: note(self, d, step, path) if step == "landed" else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loaded(spark, lake, tmp_path, "one", datetime(2024, 1, 2), document("A", {"2024-01-01": 1}))
    before = silver_of(lake)
    loaded(spark, lake, tmp_path, "two", datetime(2024, 1, 3), document("B", {"2024-01-02": 3}))
    assert len(before) == 1 and set(before) < set(silver_of(lake))
    assert {k: v[0] for k, v in facts_of(lake).items()} == {("A", 20240101): 1, ("B", 20240102): 3}


LOADS = {
    "one": (datetime(2024, 1, 5), [document("A", {"2024-01-01": 1, "2024-02-01": 5}), document("B", {"2024-01-01": 7})]),
    "two": (datetime(2024, 2, 5), [document("A", {"2024-01-01": 2, "2024-02-01": 5})]),
    "three": (datetime(2024, 3, 5), [document("A", {"2024-01-01": 1, "2024-02-01": 6}), document("B", {"2024-01-01": 7})])}


@pytest.mark.parametrize("order", [("three", "two", "one"), ("two", "three", "one")], ids="_".join)
def test_silver_does_not_depend_on_the_order_of_deliveries(spark, lake, tmp_path, order):  # noqa: F811
    for name in order:
        when, docs = LOADS[name]
        loaded(spark, lake, tmp_path, name, when, *docs)
    end = datetime(2099, 12, 31)
    second = timedelta(seconds=1)
    one, two, three = (LOADS[name][0] for name in ("one", "two", "three"))
    assert silver_of(lake) == [
        ("A", date(2024, 1, 1), 1.0, one, two - second, False, "one"),
        ("A", date(2024, 1, 1), 1.0, three, end, True, "three"),
        ("A", date(2024, 1, 1), 2.0, two, three - second, False, "two"),
        ("A", date(2024, 2, 1), 5.0, one, three - second, False, "one"),
        ("A", date(2024, 2, 1), 6.0, three, end, True, "three"),
        ("B", date(2024, 1, 1), 7.0, one, end, True, "one")]
    assert {k: v[0] for k, v in facts_of(lake).items()} == {
        ("A", 20240101): 1, ("A", 20240201): 6, ("B", 20240101): 7}


# -- pruned reads ---------------------------------------------------------------------------

def partitions_read(spark, df):
    """Partitions each scan of the fact table read, from its metrics."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        return rows, [s.metrics().apply("numPartitions").value() for s in scans
                      if s.metrics().contains("numPartitions") and "TransactionSID" in s.toString()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_conditions_on_the_calendar_prune_months(spark, lake, tmp_path):  # noqa: F811
    # more facts than calendar, as in life: the calendar is the side whose values prune
    days = {str(date(2024, 1, 1) + timedelta(days=n)): 1 for n in range(366)}
    loaded(spark, lake, tmp_path, "one", datetime(2025, 1, 1), *(document(f"S{i}", days) for i in range(20)),
           document("A", days))
    december = lake.star().filter("Date >= '2024-12-01'").select("Date", "Close", "TransactionSID")
    rows, read = partitions_read(spark, december)
    assert len(rows) == 21 * 31 and read == [1]
    assert "dynamicpruning" in december._jdf.queryExecution().executedPlan().toString()
    rows, read = partitions_read(spark, lake.star().select("Date", "Close", "TransactionSID"))
    assert len(rows) == 21 * 366 and read == [12]
    some = lake.star(date(2024, 3, 10), date(2024, 5, 10)).select("Date", "Symbol", "TransactionSID")
    rows, read = partitions_read(spark, some)
    assert read == [3] and (min(r.Date for r in rows), max(r.Date for r in rows)) == (date(2024, 3, 10), date(2024, 5, 10))
    assert {r.Symbol for r in rows} == {"A", None}


# -- month states ---------------------------------------------------------------------------

GROUPINGS = (("Symbol",), ("Industry",), ())


@pytest.fixture
def grouped(spark, request, first):
    grouped = Lake(spark, scratch_path(spark, "lake"), "t_" + request.node.name, GROUPINGS)
    grouped.create(replace=True)
    grouped.seed_lookup(spark.createDataFrame(
        [(1, "Tech", "A", "a.svg"), (2, "Tech", "B", "b.svg"), (3, "Oil", "C", "c.svg")], schemas.SYMBOL_LOOKUP), first)
    return grouped


def same_measures(lake, by):
    by = list(by)
    want, got = m.growth_by_range(lake.star(), by), states.growth_from_states(lake.states(tuple(by)), by)
    assert "fact_daily" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, got.select(*(F.col(c).cast("string") for c in sorted(got.columns))).collect())) == sorted(
        map(repr, want.select(*(F.col(c).cast(got.schema[c].dataType).cast("string") for c in sorted(got.columns))).collect()))
    days = m.daily(lake.star(), by)
    want = m.reaggregate(m.expand_ranges(days, by), [*by, "RangeName", "SortOrder"])
    got = states.sums_from_states(lake.states(tuple(by)), by)
    names = sorted(got.columns)
    assert sorted(map(repr, got.select(names).collect())) == sorted(map(repr, want.select(names).collect()))


def test_states_follow_the_loads(spark, grouped, tmp_path, monkeypatch):
    draw = random.Random(2)
    days = [str(date(2022, 11, 1) + timedelta(days=n)) for n in range(0, 480, 5)]
    docs = [document(s, {day: draw.choice([0, 1, 2, 5]) for day in draw.sample(days, 60)}) for s in "ABCD"]
    loaded(spark, grouped, tmp_path, "one", datetime(2024, 3, 1), *docs)
    for by in GROUPINGS:
        same_measures(grouped, by)
    # a later load stops before the states: the next one makes up for it, months without changes keep their files
    january = set(grouped.states(("Symbol",)).filter("Month = 202301").inputFiles())
    with monkeypatch.context() as patch:
        patch.setattr(Lake, "refresh_states", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loaded(spark, grouped, tmp_path, "two", datetime(2024, 4, 1), document("A", {"2024-03-20": 9}))
    renamed = document("C", {"2024-03-25": 4})
    loaded(spark, grouped, tmp_path, "three", datetime(2024, 5, 1), renamed)
    for by in GROUPINGS:
        same_measures(grouped, by)
    assert set(grouped.states(("Symbol",)).filter("Month = 202301").inputFiles()) == january
    # a symbol that changes its industry takes its past along
    lookup = spark.createDataFrame([(1, "Tech", "A", "a.svg"), (2, "Oil", "B", "b.svg"), (3, "Oil", "C", "c.svg")],
                                   schemas.SYMBOL_LOOKUP)
    grouped.seed_lookup(lookup, BatchContext("seed", datetime(2024, 5, 20)))
    loaded(spark, grouped, tmp_path, "four", datetime(2024, 6, 1), document("A", {"2024-05-25": 4}))
    same_measures(grouped, ("Industry",))
