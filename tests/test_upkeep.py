"""Buckets, ranges held as a table, charts of several series, files and folders of stored tables."""

import random
import re
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from test_lake import document, facts_of, lake, loaded  # noqa: F401

from candlelake.context import BatchContext, TableSpec
from candlelake.operators import buckets, ranges, series, upkeep
from candlelake.operators.audit import add_audit_columns
from candlelake.operators.merge import scd_merge
from candlelake.session import scratch_path

STAGE = TableSpec("Stage", ("k",))


def rows_of(df):
    return sorted(tuple(str(row[c]) for c in sorted(df.columns)) for row in df.collect())


def delivery(spark, number, rows):
    batch = BatchContext(f"b{number}", datetime(2024, 1, number))
    return add_audit_columns(spark.createDataFrame(rows, "k INT, v STRING"), STAGE, batch), batch


def test_bucketed_merge_moves_only_the_delivery(spark):
    draw, name = random.Random(4), "t_bucketed"
    plain, _ = delivery(spark, 1, [(k, "a") for k in range(200)])
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    buckets.create_bucketed(plain, name, scratch_path(spark, "bucketed"), STAGE.key_hash, 6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for number in (2, 3):
            path = scratch_path(spark, "delivery")
            source, batch = delivery(spark, number, [(k, draw.choice("ab")) for k in range(0, 260, 2)])
            source.write.parquet(path)
            source = spark.read.schema(source.schema).parquet(path)
            text = buckets.merged_buckets(spark, name, source, STAGE, batch)._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"Exchange ", text)) == 1 and "hashpartitioning(__HashKey" in text
            # the exchange belongs to the delivery: nothing but a sort and a projection stands over the stored side
            stored_side = text[text.index("FullOuter"):text.index("FileScan")]
            assert "Exchange" not in stored_side and "Bucketed: true" in text
            want = scd_merge(spark.table(name), source, STAGE, batch)
            want = spark.createDataFrame(want.collect(), want.schema)
            buckets.merge_buckets(spark, name, source, STAGE, batch, scratch_path(spark, "bucketed"))
            assert rows_of(spark.table(name)) == rows_of(want)
            assert buckets.bucketing(spark, name) == (6, STAGE.key_hash)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError, match="dealt by"):
        buckets.merged_buckets(spark, name, source, TableSpec("Dim", ("k",)), batch)


# -- ranges ---------------------------------------------------------------------------------

def test_days_in_ranges_equal_brute_force(spark):
    draw = random.Random(1)
    day = lambda: draw.choice([None, *(date(2023, 12, 25) + timedelta(days=n) for n in range(0, 200, 3))])
    days = [(s, day(), i) for i, s in enumerate(draw.choices("ab", k=120))]
    spans = [(f"r{i % 30}", day(), day()) for i in range(40)] + [("all", None, None), ("late", date(2030, 1, 1), None)]
    left = spark.createDataFrame(days, "s STRING, Date DATE, i INT")
    right = spark.createDataFrame(spans, "RangeName STRING, StartDate DATE, EndDate DATE")
    for width in (1, 7, 64, 5000):
        got = ranges.days_in_ranges(left, right, bin_days=width)
        want = [(i, name, a, b) for s, d, i in days for name, a, b in spans
                if d and (a is None or a <= d) and (b is None or d <= b)]
        assert sorted(map(repr, ((r.i, r.RangeName, r.StartDate, r.EndDate) for r in got.collect()))) == sorted(map(repr, want))
        text = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text
    assert ranges.days_in_ranges(left.limit(0), right).collect() == []
    assert ranges.days_in_ranges(left, right.limit(0)).collect() == []


def test_slicer_without_known_choice_falls_back(spark):
    known = spark.createDataFrame([("x", None, None), ("y", None, None)], "RangeName STRING, StartDate DATE, EndDate DATE")
    names = lambda chosen: sorted(r.RangeName for r in ranges.chosen_ranges(
        known, spark.createDataFrame([(c,) for c in chosen], "RangeName STRING"), "y").collect())
    assert (names(["x", "x"]), names([]), names(["z"]), names(["x", "y"])) == (["x"], ["y"], ["y"], ["x", "y"])


# -- charts ---------------------------------------------------------------------------------

def test_sample_of_several_series_and_measures(spark):
    draw = random.Random(7)
    rows = [(name, date(2024, 1, 1) + timedelta(days=n), draw.choice([None, *range(9)]), draw.choice([None, *range(9)]))
            for name, size in (("a", 200), ("b", 30), (None, 150), ("c", 90), ("d", 200)) for n in range(size)]
    df = spark.createDataFrame(rows, "s STRING, d DATE, u INT, v INT")
    got = series.sample_axis(df, "d", ["u", "v"], "s", points=150, least=10, most=10_000, most_series=3)
    found = {}
    for row in got.collect():
        found.setdefault(row.s, {})[row.d] = (row.u, row.v)
    assert set(found) == {"a", "b", "c"}
    assert {s: len(found[s]) for s in found} == {"a": len(found["a"]), "b": 30, "c": len(found["c"])}
    whole = {s: {d: (u, v) for name, d, u, v in rows if name == s} for s in found}
    for name in "ac":
        known = {d: x for d, x in whole[name].items() if x != (None, None)}
        assert 15 < len(found[name]) <= 50 and found[name].items() <= known.items()
        assert min(found[name]) == min(known) and max(found[name]) == max(known)
        for i in (0, 1):
            values = [x[i] for x in known.values() if x[i] is not None]
            kept = [x[i] for x in found[name].values() if x[i] is not None]
            assert (min(kept), max(kept)) == (min(values), max(values))
    # a bound on all points wins over the least of a series; blank series come last
    tight = series.sample_axis(df, "d", ["u"], "s", points=150, least=100, most=60, most_series=5)
    assert tight.count() <= 60 and {row.s for row in tight.select("s").distinct().collect()} == {None, "a", "b", "c", "d"}
    one = series.sample_axis(df.filter("s = 'a'").drop("s"), "d", ["u"], points=20, least=5)
    assert 10 < one.count() <= 20
    assert series.sample_axis(df.limit(0), "d", ["u"], "s").collect() == []


# -- files and folders ----------------------------------------------------------------------

def test_compacted_and_swept_lake_reads_the_same(spark, lake, tmp_path):  # noqa: F811
    for n in range(3):
        loaded(spark, lake, tmp_path, f"load{n}", datetime(2024, 2, 1 + n),
               *(document(s, {"2024-01-30": n, f"2024-01-{1 + n:02}": n + 1}) for s in "AB"))
    facts, silver = facts_of(lake), rows_of(lake.table("silver"))
    later = datetime.now(timezone.utc) + timedelta(hours=1)
    assert lake.sweep(datetime.now(timezone.utc) - timedelta(days=1)) == []
    gone = lake.sweep(later)
    assert any("fact_daily/load0" in place for place in gone) and facts_of(lake) == facts
    assert rows_of(lake.table("silver")) == silver and lake.deliveries() == []
    live = {upkeep._plain(spark, place) for place in upkeep.live_locations(spark, [lake.name("silver"), lake.name("fact_daily")])}
    for kind in ("silver", "fact_daily"):
        for place in upkeep.older_folders(spark, lake.path(kind), later):
            assert any(f"{path}/".startswith(f"{place}/") for path in live)
    # loads go on after a sweep, a late one included
    loaded(spark, lake, tmp_path, "late", datetime(2024, 1, 31), document("A", {"2024-01-30": 9}))
    spans = sorted((r["__EffectiveStartDateTime"], r["__EffectiveEndDateTime"], float(r.Close)) for r in
                   lake.table("silver").filter("Symbol = 'A' and Date = '2024-01-30'").collect())
    assert [s[2] for s in spans] == [9, 0, 1, 2] and all(a < b for a, b, _ in spans)
    loaded(spark, lake, tmp_path, "next", datetime(2024, 2, 9), document("B", {"2024-02-03": 9}))
    assert facts_of(lake)[("B", 20240203)][0] == 9 and facts_of(lake)[("A", 20240130)] == facts[("A", 20240130)]


def test_compaction_packs_only_crowded_folders(spark):
    name, path = "t_appended", scratch_path(spark, "appended")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (s STRING, v BIGINT, m MAP<STRING, STRING>, Bucket INT) USING PARQUET "
              f"PARTITIONED BY (Bucket) LOCATION '{path}/first'")
    for n in range(4):
        upkeep.append_hashed(spark.range(n * 100, n * 100 + 100).select(
            F.concat(F.lit("s"), F.col("id") % 7).alias("s"), F.col("id").alias("v"),
            F.create_map(F.lit("k"), F.col("id").cast("string")).alias("m")), name, "s", 3)
    before = sorted((r.s, r.v, str(r.m)) for r in spark.table(name).collect())
    counts = {r.Bucket: r["count"] for r in upkeep.files_of(spark, name, "Bucket").groupBy("Bucket").count().collect()}
    assert min(counts.values()) >= 4
    done = upkeep.compact(spark, name, "Bucket", f"{path}/packed")
    assert done == sorted(counts)
    after = {r.Bucket: r["count"] for r in upkeep.files_of(spark, name, "Bucket").groupBy("Bucket").count().collect()}
    assert set(after.values()) == {1} and sorted((r.s, r.v, str(r.m)) for r in spark.table(name).collect()) == before
    assert upkeep.compact(spark, name, "Bucket", f"{path}/again") == []
    assert {r.s: r.Bucket for r in spark.table(name).select("s", "Bucket").distinct().collect()}.keys() == {f"s{i}" for i in range(7)}
