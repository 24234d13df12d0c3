"""Keys, audit columns, merges, fact sync."""

import hashlib
from datetime import datetime

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from candlelake.context import BatchContext, TableSpec
from candlelake.functions import keys
from candlelake.operators.audit import add_audit_columns
from candlelake.operators.merge import (
    changed_rows, check_source, duplicate_keys, fact_sync, insert_only, not_matched, scd_merge, type1_update)
from candlelake.operators.surrogate import assign_surrogates, number_missing, positions
from candlelake.plans.handler import VersionedLoad

DIM = TableSpec("Dim", ("k",), ("a",))
STRICT_DIM = TableSpec("Dim", ("k",), ("a",), strict=True)
STAGE = TableSpec("Stage", ("k",))
FACT = TableSpec("Fact", ("k", "d"), ("v",))
STRICT_FACT = TableSpec("Fact", ("k", "d"), ("v",), strict=True)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows(spark, data, spec, batch, ddl="k int, a int, b string"):
    return add_audit_columns(spark.createDataFrame(data, ddl), spec, batch)


def facts(spark, data, batch, spec=FACT):
    return add_audit_columns(spark.createDataFrame(data, "k int, d int, v int"), spec, batch)


def content(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)


# -- contract -------------------------------------------------------------------------------

def test_params_are_checked():
    spec = TableSpec.from_params({"businessColumns": " x , y,", "typeIColumns": "", "tableType": "Dim"})
    assert spec.business_columns == ("x", "y") and spec.type1_columns == ()
    with pytest.raises(ValueError, match="lack tableType"):
        TableSpec.from_params({"businessColumns": "x", "typeIColumns": ""})
    with pytest.raises(ValueError, match="tableType"):
        TableSpec.from_params({"businessColumns": "x", "typeIColumns": "", "tableType": "View"})


def test_end_is_one_second_before_start():
    assert BatchContext("b", datetime(2024, 1, 1)).end == "2023-12-31 23:59:59"


def test_hashes(spark):
    df = spark.createDataFrame([("a", None, "b")], "x string, y string, z string")
    plain, marked = df.select(keys.joined_hash(["x", "y", "z"]), keys.joined_hash(["x", "y", "z"], "~")).head()
    assert plain == sha("a|b") and marked == sha("a|~|b")


def test_change_hash_sorts_and_skips_audit_and_type1(spark):
    df = spark.createDataFrame([(1, 2, "c")], "k int, a int, b string").withColumn("__lastmodified", F.lit("x"))
    assert df.select(keys.change_hash(df.columns, DIM)).head()[0] == sha("c|1")
    assert df.select(keys.type1_hash(TableSpec("Dim", ("k",)))).head()[0] == sha("")


def test_audit_columns_by_type(spark, first):
    dim = rows(spark, [(1, 1, "x")], DIM, first)
    stage = rows(spark, [(1, 1, "x")], STAGE, first)
    fact = facts(spark, [(1, 1, 1)], first)
    assert [len(df.columns) - 3 for df in (dim, stage, fact)] == [11, 11, 5]
    row = dim.head()
    assert row["__CurrentFlag"] and not row["__DeletedFlag"]
    assert row["__EffectiveEndDateTime"] == datetime(2099, 12, 31) and row["__UpdatedBatchLogId"] is None


# -- versions -------------------------------------------------------------------------------

def test_dim_merge_cases(spark, first, second):
    target = rows(spark, [(1, 1, "x"), (2, 1, "x"), (3, 1, "x"), (4, 1, "x"), (5, 1, "x")], DIM, first)
    source = rows(spark, [(1, 1, "x"), (2, 9, "x"), (3, 1, "y"), (4, 9, "y"), (6, 1, "x")], DIM, second)
    merged = scd_merge(target, source, DIM, second)
    assert content(merged, "k", "a", "b", "__CurrentFlag", "__UpdatedBatchLogId") == sorted([
        (1, 1, "x", True, None),         # unchanged
        (2, 9, "x", True, "second"),     # overwritten
        (3, 1, "x", False, "second"), (3, 1, "y", True, None),   # new version
        (4, 9, "x", False, "second"), (4, 9, "y", True, None),   # both
        (5, 1, "x", True, None),         # missing from the source
        (6, 1, "x", True, None),         # new key
    ], key=repr)
    closed = merged.filter("k = 3 and not __CurrentFlag").head()
    opened = merged.filter("k = 3 and __CurrentFlag").head()
    assert closed["__EffectiveEndDateTime"] == datetime(2024, 1, 31, 23, 59, 59)
    assert opened["__EffectiveStartDateTime"] == datetime(2024, 2, 1)


def test_merging_twice_changes_nothing(spark, first, second, third):
    target = rows(spark, [(1, 1, "x"), (2, 1, "x")], DIM, first)
    once = scd_merge(target, rows(spark, [(1, 2, "y"), (3, 3, "z")], DIM, second), DIM, second)
    twice = scd_merge(once, rows(spark, [(1, 2, "y"), (3, 3, "z")], DIM, third), DIM, third)
    assert content(once, *once.columns) == content(twice, *once.columns)


def test_versions_do_not_overlap(spark, first, second, third):
    table = rows(spark, [(1, 1, "x")], STAGE, first)
    table = scd_merge(table, rows(spark, [(1, 1, "y")], STAGE, second), STAGE, second)
    table = scd_merge(table, rows(spark, [(1, 1, "x")], STAGE, third), STAGE, third)
    spans = content(table, "__EffectiveStartDateTime", "__EffectiveEndDateTime")
    assert len(spans) == 3 and table.filter("__CurrentFlag").count() == 1
    assert all(left[1] < right[0] for left, right in zip(spans, spans[1:]))


def test_empty_target_and_empty_source(spark, first, second):
    some = rows(spark, [(1, 1, "x")], STAGE, first)
    none = some.limit(0)
    assert content(scd_merge(none, some, STAGE, first), "k") == [(1,)]
    assert content(scd_merge(some, none, STAGE, second), *some.columns) == content(some, *some.columns)


@pytest.mark.parametrize("spec, final", [(DIM, 1), (STRICT_DIM, 2)])
def test_type1_value_returning_to_the_old_one(spark, first, second, third, spec, final):
    """Strict mode keeps the stored hash, so the way back from 2 to 1 goes unnoticed."""
    table = rows(spark, [(1, 1, "x")], spec, first)
    table = type1_update(table, rows(spark, [(1, 2, "x")], spec, second), spec, second)
    table = type1_update(table, rows(spark, [(1, 1, "x")], spec, third), spec, third)
    assert content(table, "a") == [(final,)]


def test_type1_update_leaves_closed_versions(spark, first, second):
    table = rows(spark, [(1, 1, "x")], DIM, first).withColumn("__CurrentFlag", F.lit(False))
    assert content(type1_update(table, rows(spark, [(1, 2, "x")], DIM, second), DIM, second), "a") == [(1,)]


def test_ids_are_unique_and_stable(spark, first, second):
    source = rows(spark, [(k, 1, "x") for k in range(50)], DIM, first)
    empty = source.withColumn("id", F.lit(0).cast("bigint")).limit(0)
    one = scd_merge(empty, source, DIM, first, id_column="id")
    two = scd_merge(one, rows(spark, [(k, 1, "y" if k < 10 else "x") for k in range(60)], DIM, second),
                    DIM, second, id_column="id")
    ids = dict(content(one, "k", "id"))
    assert len(set(ids.values())) == 50 and min(ids.values()) >= 1
    rows_two = content(two, "k", "id", "b")
    assert len({row[1] for row in rows_two}) == len(rows_two) == 70
    assert all(ids[k] == i for k, i, b in rows_two if b == "x" and k < 50)
    assert all(i > max(ids.values()) for k, i, b in rows_two if b == "y" or k >= 50)


def test_duplicate_source_is_refused(spark, first):
    twice = rows(spark, [(1, 1, "x"), (1, 2, "y"), (2, 1, "x")], STAGE, first)
    assert content(duplicate_keys(twice, STAGE), "__HashKey", "RowCount") == [(sha("1"), 2)]
    with pytest.raises(ValueError, match="2 rows"):
        check_source(twice, STAGE)
    assert check_source(twice.filter("k = 2"), STAGE).count() == 1


@pytest.mark.parametrize("spec", [STAGE, DIM, FACT])
def test_merges_refuse_two_rows_for_a_key(spark, first, spec):
    source = facts(spark, [(1, 20240101, 1), (1, 20240101, 2), (2, 20240101, 1)], first, spec) if spec is FACT else \
        rows(spark, [(1, 1, "x"), (1, 2, "y"), (2, 1, "x")], spec, first)
    empty = source.limit(0)
    merged = fact_sync(empty, source, spec) if spec is FACT else scd_merge(empty, source, spec, first)
    with pytest.raises(SparkRuntimeException, match="2 rows for key"):
        merged.collect()


def test_changed_rows(spark, first):
    target = rows(spark, [(1, 1, "x"), (2, 1, "x"), (3, 1, "x")], DIM, first)
    source = rows(spark, [(1, 1, "x"), (2, 2, "x"), (3, 1, "y"), (4, 1, "x")], DIM, first)
    assert content(changed_rows(target, source, DIM), "k") == [(2,), (3,), (4,)]


def test_insert_only_and_not_matched(spark, first):
    held = spark.createDataFrame([(1, "old")], "k int, b string")
    new = spark.createDataFrame([("new", 1), ("new", 2)], "b string, k int")
    assert content(insert_only(held, new, ["k"]), "k", "b") == [(1, "old"), (2, "new")]
    stored = rows(spark, [(1, 1, "x"), (2, 1, "x")], STAGE, first).withColumn("__CurrentFlag", F.col("k") == 1)
    assert content(not_matched(stored, rows(spark, [(1, 1, "x"), (2, 1, "x")], STAGE, first), STAGE), "k") == [(2,)]


# -- facts ----------------------------------------------------------------------------------

OLD = [(1, 20240101, 1), (1, 20240102, 1), (2, 20240102, 1), (1, 20240103, 1)]
NEW = [(1, 20240102, 5), (1, 20240103, 1), (3, 20240103, 1)]


def test_fact_sync_keeps_history_and_replaces_changes(spark, first, second):
    target, source = facts(spark, OLD, first), facts(spark, NEW, second)
    synced = fact_sync(target, source, FACT, F.col("d").between(20240102, 20240103))
    assert content(synced, "k", "d", "v", "__CreatedBatchLogId") == sorted([
        (1, 20240101, 1, "first"), (1, 20240102, 5, "second"), (1, 20240103, 1, "first"),
        (3, 20240103, 1, "second")], key=repr)
    assert content(fact_sync(synced, source, FACT, F.col("d") >= 20240102), *synced.columns) == content(
        synced, *synced.columns)


def test_strict_fact_sync_loses_changed_rows_until_the_next_run(spark, first, second):
    target = facts(spark, OLD, first, STRICT_FACT)
    source = facts(spark, NEW, second, STRICT_FACT)
    once = fact_sync(target, source, STRICT_FACT)
    assert content(once, "k", "d", "v") == [(1, 20240103, 1), (3, 20240103, 1)]
    assert content(fact_sync(once, source, STRICT_FACT), "k", "d", "v") == sorted(NEW)


def test_numbering(spark):
    df = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    for ranges in (None, 1, 300):
        dense = [row[0] for row in positions(df, F.col("h"), "n", ranges).orderBy("h").select("n").collect()]
        assert dense == list(range(1, 1001))
    assert positions(df.limit(0), F.col("h"), "n").collect() == []
    some = df.withColumn("id", F.when(F.col("h") < "8", F.crc32("h") + 10 ** 10))
    rows = number_missing(some, "id", F.col("h"), F.lit(50)).orderBy("h").collect()
    assert [row.id for row in rows if row.h >= "8"] == list(range(51, 51 + sum(row.h >= "8" for row in rows)))
    assert all(row.id >= 10 ** 10 for row in rows if row.h < "8")
    # ties share no number
    equal = positions(spark.range(100).withColumn("h", F.lit("x")), F.col("h"), "n").select("n").collect()
    assert sorted(row[0] for row in equal) == list(range(1, 101))
    sparse = [row[0] for row in assign_surrogates(df.repartition(5), "n", F.lit(7)).select("n").collect()]
    assert len(set(sparse)) == 1000 and min(sparse) > 7


# -- against brute force --------------------------------------------------------------------

def simulate(table, source, batch, strict):
    """The merge statements one after the other on plain rows: type 1, type 2, insert."""
    for row in table:
        new = source.get(row["k"])
        if row["current"] and new and new["a"] != row["h1"]:
            row["a"] = new["a"]
            if not strict:
                row["h1"] = new["a"]
    for row in table:
        new = source.get(row["k"])
        if row["current"] and new and new["b"] != row["b"]:
            row.update(current=False, closed=batch)
    held = {row["k"] for row in table if row["current"]}
    return table + [{"k": k, "a": new["a"], "h1": new["a"], "b": new["b"], "current": True, "opened": batch, "closed": None}
                    for k, new in source.items() if k not in held]


@pytest.mark.parametrize("spec", [DIM, STRICT_DIM])
def test_random_loads_match_sequential_statements(spark, spec):
    import random
    rng = random.Random(3)
    expected, table = [], None
    for n in range(4):
        batch = BatchContext(f"load-{n}", datetime(2024, n + 1, 1))
        source = {k: {"a": rng.randint(1, 3), "b": rng.choice("xyz")} for k in rng.sample(range(60), 40)}
        audited = rows(spark, [(k, v["a"], v["b"]) for k, v in source.items()], spec, batch)
        merged = audited if table is None else scd_merge(table, audited, spec, batch)
        table = spark.createDataFrame(merged.collect(), merged.schema)
        expected = simulate(expected, source, batch.batch_id, spec.strict)
        got = {(r.k, r.a, r.b, r["__CurrentFlag"], r["__CreatedBatchLogId"]) for r in table.collect()}
        assert got == {(r["k"], r["a"], r["b"], r["current"], r["opened"]) for r in expected}
        assert table.count() == len(expected)


def test_load_configured_by_parameters(spark, first):
    load = VersionedLoad({"businessColumns": "k", "typeIColumns": "a", "tableType": "Dim"}, batch=first)
    load.refresh_timestamp()
    assert load.batch.batch_id == "first" and load.batch.effective_ts > first.effective_ts
    source = load.add_audit_columns(spark.createDataFrame([(1, 1, "x")], "k int, a int, b string"))
    assert content(load.merge(source.limit(0), source), "k", "__CreatedBatchLogId") == [(1, "first")]
    sync = VersionedLoad({"businessColumns": "k,d", "typeIColumns": "v", "tableType": "Fact"}, batch=first)
    held = sync.add_audit_columns(spark.createDataFrame([(1, 1, 1), (1, 2, 1)], "k int, d int, v int"))
    new = sync.add_audit_columns(spark.createDataFrame([(1, 2, 5)], "k int, d int, v int"))
    assert content(sync.merge(held, new, scope=F.col("d") == 2), "d", "v") == [(1, 1), (2, 5)]
