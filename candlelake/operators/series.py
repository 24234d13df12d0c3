"""Reducing a long series to a bounded number of points."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

# Points a chart aims at, least points of a series, most points in all, most series.
MAX_POINTS = 3500
LEAST_POINTS, MOST_POINTS, MOST_SERIES = 350, 105_000, 60


def _offset(axis: Column, start: Column, kind: DataType) -> Column:
    """Distance from the start in the axis's own unit: days, microseconds, or the number itself."""
    if isinstance(kind, DateType):
        return F.datediff(axis, start).cast("bigint")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(axis.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return axis - start


def downsample_minmax(df: DataFrame, by: Sequence[str], axis: str, value: str,
                      max_points: int = MAX_POINTS) -> DataFrame:
    """At most ``max_points`` rows per series, keeping both ends and local extremes.

    The axis (dates, timestamps or numbers) between the ends is cut into equal bins; each keeps its
    lowest and its highest point, the earlier one on ties. Points without a value are left out; a
    series that is short enough comes back whole, blanks included. ``(by, axis)`` must be unique.

    Extremes and their places are fixed-width aggregates over (series, bin), so points collapse on the
    map side before they move and a long series never meets in one task. Only then are the few chosen
    places joined with the points, which a skew split or a broadcast can serve. ``df`` is read three
    times: pass a stored table or a cheap plan.
    """
    bins = max((max_points - 2) // 2, 1)
    known, kind = F.col(value).isNotNull(), df.schema[axis].dataType
    ends = df.groupBy(*by).agg(
        F.min(F.when(known, F.col(axis))).alias("_from"), F.max(F.when(known, F.col(axis))).alias("_to"),
        F.count(F.lit(1)).alias("_points"))
    share = _offset(F.col(axis), F.col("_from"), kind) / _offset(F.col("_to"), F.col("_from"), kind)
    bin_no = (F.when(F.col(axis) == F.col("_from"), F.lit(-1))
              .when(F.col(axis) == F.col("_to"), F.lit(bins))
              .otherwise(F.least(F.floor(share * bins), F.lit(bins - 1)))).cast("bigint")
    placed = _joined(df, ends, by)
    short = placed.filter(F.col("_points") <= max_points).select(*df.columns)
    long = placed.filter((F.col("_points") > max_points) & known).withColumn("_bin", bin_no)
    keys = [*by, "_bin"]
    extremes = long.groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    hits = _joined(long, extremes, keys).filter(F.col(value).isin(F.col("_low"), F.col("_high")))
    chosen = hits.groupBy(*keys).agg(
        F.min(F.when(F.col(value) == F.col("_low"), F.col(axis))).alias("_low_at"),
        F.min(F.when(F.col(value) == F.col("_high"), F.col(axis))).alias("_high_at"))
    places = chosen.select(*by, F.explode(F.array_distinct(F.array("_low_at", "_high_at"))).alias(axis))
    return short.unionByName(_joined(df, places, [*by, axis]).select(*df.columns))


def sample_axis(df: DataFrame, axis: str, measures: Sequence[str], series: str | None = None,
                points: int = MAX_POINTS, least: int = LEAST_POINTS, most: int = MOST_POINTS,
                most_series: int = MOST_SERIES) -> DataFrame:
    """A chart's points for several measures and series over one axis.

    The first ``most_series`` series by name are shown, blank last. ``points`` are shared out among them, at
    least ``least`` each, unless that makes more than ``most`` in all. A series with no more rows than its
    share comes back whole. Of any other, bins that all series and measures share keep the rows where a measure
    is lowest or highest (the first such row), and both ends of the series stay; rows without any measure go.
    ``(series, axis)`` must be unique. What a bin keeps are fixed-width aggregates, so points collapse before
    they move; ``df`` is read a few times whatever the number of measures: pass a stored table or a cheap plan.
    """
    by = [series] if series else []
    name = F.col(series) if series else F.lit(None)
    shown = df.select(name.alias("_series")).distinct().orderBy(F.asc_nulls_last("_series")).limit(most_series)
    rows = df.join(F.broadcast(shown), name.eqNullSafe(F.col("_series")), "left_semi") if series else df
    n = F.greatest(shown.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    share = F.least(F.floor(F.lit(most) / n), F.greatest(F.floor(F.lit(points) / n), F.lit(least)))
    bins = F.greatest(F.floor((share - 2) / (2 * len(measures))), F.lit(1))
    known, kind = F.coalesce(*measures).isNotNull(), df.schema[axis].dataType
    ends = rows.groupBy(*by).agg(
        F.min(F.when(known, F.col(axis))).alias("_from"), F.max(F.when(known, F.col(axis))).alias("_to"),
        F.count(F.lit(1)).alias("_points"))
    whole = ends.agg(F.min("_from").alias("a"), F.max("_to").alias("b"))
    first, last = whole.select("a").scalar(), whole.select("b").scalar()
    place = _offset(F.col(axis), first, kind) / F.nullif(_offset(last, first, kind), F.lit(0))
    placed = _joined(rows, ends, by)
    short = placed.filter(F.col("_points") <= share).select(*df.columns)
    long = placed.filter((F.col("_points") > share) & known) \
        .withColumn("_bin", F.coalesce(F.least(F.floor(place * bins), bins - 1), F.lit(0)))
    keys = [*by, "_bin"]
    extremes = long.groupBy(*keys).agg(*(
        end(value).alias(f"_{side}{i}") for i, value in enumerate(measures) for side, end in (("low", F.min), ("high", F.max))))
    marks = [(F.col(value), F.col(f"_{side}{i}")) for i, value in enumerate(measures) for side in ("low", "high")]
    hits = _joined(long, extremes, keys).filter(reduce(lambda a, b: a | b, (value == mark for value, mark in marks)))
    chosen = hits.groupBy(*keys).agg(*(
        F.min(F.when(value == mark, F.col(axis))).alias(f"_at{i}") for i, (value, mark) in enumerate(marks)))
    places = chosen.select(*by, F.array(*(f"_at{i}" for i in range(len(marks)))).alias("_places")).unionByName(
        ends.filter(F.col("_points") > share).select(*by, F.array("_from", "_to").alias("_places")))
    kept = places.select(*by, F.explode("_places").alias(axis)).filter(F.col(axis).isNotNull()).distinct()
    return short.unionByName(_joined(rows, kept, [*by, axis]).select(*df.columns))


def _joined(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left rows with the other columns of their group; blank groups match."""
    renamed = right.withColumnsRenamed({name: f"_of_{name}" for name in by})
    if not by:
        return left.crossJoin(F.broadcast(renamed))  # one row
    same = (F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in by)
    return left.join(renamed, reduce(lambda a, b: a & b, same)).drop(*(f"_of_{name}" for name in by))
