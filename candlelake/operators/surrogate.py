"""Numbering rows without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.session import stored


def highest_id(table: DataFrame, id_column: str) -> Column:
    """The highest id in a table as a scalar subquery; 0 for an empty one."""
    return F.coalesce(table.agg(F.max(id_column)).scalar(), F.lit(0))


def fresh_id(above: Column | None = None) -> Column:
    """A new unique id for every row of the select it stands in, greater than ``above``.

    Every task numbers its own rows inside a range of its own: no shuffle, no sort, no limit on tasks.
    Like those of an identity column the ids have gaps, and they change when the rows are computed
    anew: write them before they are read twice.
    """
    top = above if above is not None else F.lit(0)
    return (F.monotonically_increasing_id() + 1 + top).cast("bigint")


def assign_surrogates(rows: DataFrame, id_column: str, above: Column | None = None) -> DataFrame:
    return rows.withColumn(id_column, fresh_id(above))


def positions(rows: DataFrame, order: Column, name: str, ranges: int | None = None) -> DataFrame:
    """Gapless ``row_number() over (order by order)`` for any number of rows.

    Rows are dealt to ranges whose bounds Spark samples (as many as shuffle partitions unless ``ranges`` says
    so), sorted inside them and written once, each with its place in its range. What meets in one task are the
    counts of the ranges, one row per written range; they shift the places. Rows of equal order follow each
    other in no fixed way. Reads ``rows`` once; the result is a plan over the written table.
    """
    spark = rows.sparkSession
    dealt = rows.withColumn("_order", order)
    dealt = dealt.repartitionByRange(ranges, "_order") if ranges else dealt.repartitionByRange("_order")
    kept = stored(dealt.sortWithinPartitions("_order").withColumn("_place", F.monotonically_increasing_id())
                  .drop("_order"), "positions")
    inside = (1 << 33) - 1
    numbered = kept.withColumn("_range", F.shiftright("_place", 33))
    counts = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    limit = int(spark.conf.get("spark.sql.shuffle.partitions")) if ranges is None else ranges
    offsets = F.broadcast(offsets) if limit <= 100_000 else offsets
    number = F.col("_offset") + F.col("_place").bitwiseAND(F.lit(inside)) + 1
    return numbered.join(offsets, "_range").withColumn(name, number.cast("bigint")) \
        .select(*rows.columns, *([] if name in rows.columns else [name]))


def number_missing(rows: DataFrame, id_column: str, order: Column, above: Column) -> DataFrame:
    """Gapless ids above ``above`` for the rows without one, in the given order.

    Rows are computed and written once; those without an id, which are few, are then sorted by ranges.
    """
    kept = stored(rows, "unnumbered")
    new = positions(kept.filter(F.col(id_column).isNull()), order, "_position")
    numbered = new.withColumn(id_column, (F.col("_position") + above).cast("bigint")).drop("_position")
    return kept.filter(F.col(id_column).isNotNull()).unionByName(numbered)
