"""Plans stay the ones meant for large tables."""

import re

import pytest

from candlelake.queries import QUERIES
from candlelake.operators import measures as m
from candlelake.operators.series import downsample_minmax
from candlelake.plans import market


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", plan(df)))


TEXT_MEMBERS = ("agg_max_logo", "selected_value", "selected_value_default", "slicer_ranges")
LAZY = sorted(name for name in QUERIES if not name.startswith("sink_"))


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", text)
    # a sort before aggregation means a buffer that cannot be hashed: only the lines of a day's first and
    # last order, and the members of a group (texts), are aggregated so
    sorted_ = re.findall(r"SortAggregate\(key=\[.*?functions=\[(.*)\]", text)
    assert all("l_linenumber" in functions or name in TEXT_MEMBERS for functions in sorted_)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# Shuffles where nothing is small enough to broadcast. Bars take seven: trades and suppliers (2), days, and
# the names of nation, region and symbol (4); growth adds days of a group and groups.
@pytest.mark.parametrize("name, most", [
    ("agg_avg_volume", 8), ("growth_pct", 9), ("report_symbol_cards", 9), ("fact_sync_merge", 4),
    ("scd2_stage_merge", 4), ("scd2_dim_merge", 2), ("report_industry_pivot", 14)])
def test_shuffles_without_broadcast(spark, folder, no_broadcast, name, most):
    df = QUERIES[name](spark, folder)
    assert "BroadcastExchange" not in plan(df) and exchanges(df) <= most


def test_sampling_moves_points_only_after_they_collapsed_or_by_place(spark, no_broadcast):
    """No aggregate reads a join without an exchange by bin between them, so no series meets in one task."""
    df = spark.range(9).selectExpr("'a' as s", "id as d", "id as v")
    text = plan(downsample_minmax(df, ["s"], "d", "v", 4))
    assert "SortAggregate" not in text and "Window" not in text


def test_scan_reads_only_used_columns(spark, folder):
    text = plan(QUERIES["agg_avg_volume"](spark, folder))
    schema = re.search(r"lineitem.*?ReadSchema: struct<([^>]*)>", text, re.S).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {"l_suppkey", "l_quantity", "l_shipdate"}


def test_incremental_bound_reaches_the_scan(spark, folder):
    assert "GreaterThan(ts" in plan(QUERIES["src_changed_since"](spark, folder))


def test_growth_shuffles_days_once_per_step(spark, folder):
    """Trades to days, days of a group, groups; windows and all six ranges add no further shuffle."""
    assert exchanges(m.growth_by_range(market.bars(spark, folder), ["Symbol"])) == 3


def test_merge_joins_once(spark, folder):
    text = plan(QUERIES["scd2_dim_merge"](spark, folder))
    assert text.count("FullOuter") == 1 and exchanges(QUERIES["scd2_dim_merge"](spark, folder)) == 2
