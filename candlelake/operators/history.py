"""Versions by effective time: deliveries in any order give the table that the ordered loads give.

A merge against current versions (:mod:`candlelake.operators.merge`) is right for a batch newer than what it
meets. A late batch needs more than the current version: its value may belong between two closed versions,
and a value that a later delivery merely confirmed must come back after it. Both follow from the deliveries
themselves: the versions of a key are a fold over everything delivered for it, in order of effective start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.context import TableSpec
from candlelake.operators.audit import OPEN_END, at
from candlelake.operators.merge import aligned, guarded
from candlelake.schemas import empty_of

START = "__EffectiveStartDateTime"


def _second_before(stamp: Column) -> Column:
    return stamp - F.expr("INTERVAL 1 SECOND")


def fold_versions(observations: DataFrame, spec: TableSpec) -> DataFrame:
    """The version table that merging the observations one batch after the other gives.

    ``observations`` are audited rows of any number of deliveries, each with its own start and batch, one row
    per key and delivery. Rows of a key with the same start are taken in order of their batch ids, and only the
    last of them counts. A value that does not differ from the one before opens no version. Type-1 columns hold
    what the last delivery under a version brought, the one that closed it included. One shuffle on the key;
    a key has at most one row per delivery.
    """
    by_start = Window.partitionBy(spec.key_hash).orderBy(START)
    batches = Window.partitionBy(spec.key_hash, START).orderBy("__CreatedBatchLogId")
    later = by_start.rowsBetween(1, Window.unboundedFollowing)
    upto = by_start.rowsBetween(Window.unboundedPreceding, 0)
    rows = observations.withColumn("_last", F.lead(F.lit(1)).over(batches).isNull()).filter("_last").drop("_last")
    before = F.lag(spec.value_hash).over(by_start)
    rows = rows.withColumn("_opens", ~before.eqNullSafe(F.col(spec.value_hash)))
    # what closes the version: the next row that opens one
    closing = F.struct(START, "__CreatedBatchLogId", *_type1(spec))
    rows = rows.withColumn("_closing", F.first(F.when(F.col("_opens"), closing), ignorenulls=True).over(later)) \
        .withColumn("_version", F.sum(F.col("_opens").cast("int")).over(upto))
    changes = {"__EffectiveEndDateTime": F.coalesce(_second_before(F.col(f"_closing.{START}")), at(OPEN_END)),
               "__CurrentFlag": F.col("_closing").isNull()}
    updated = F.col("_closing")
    if _type1(spec):
        # a delivery that only changes type-1 values updates the version without closing it
        inside = Window.partitionBy(spec.key_hash, "_version").orderBy(START)
        rest = inside.rowsBetween(1, Window.unboundedFollowing)
        whole = inside.rowsBetween(0, Window.unboundedFollowing)
        touched = ~F.col("__Hash1Type").eqNullSafe(F.lag("__Hash1Type").over(inside)) & ~F.col("_opens")
        rows = rows.withColumn("_touched", touched) \
            .withColumn("_update", F.last(F.when(F.col("_touched"), closing), ignorenulls=True).over(rest)) \
            .withColumn("_newest", F.last(closing).over(whole))
        updated = F.coalesce("_closing", "_update")
        newest = F.coalesce("_closing", "_newest")
        changes |= {name: newest[name] for name in _type1(spec)}
    # a version that takes part as an observation keeps the stamps of updates that are not looked at again
    for name, value in (("__UpdatedBatchLogId", updated["__CreatedBatchLogId"]), ("__UpdateDateTime", updated[START]),
                        ("__lastmodified", F.col(f"_closing.{START}"))):
        if name in observations.columns:
            changes[name] = F.coalesce(value, F.col(name))
    versions = rows.filter("_opens")
    return versions.select(*(changes.get(name, F.col(name)).alias(name) for name in observations.columns))


def _type1(spec: TableSpec) -> list[str]:
    return [*spec.type1_columns, "__Hash1Type"] if spec.table_type == "Dim" and spec.type1_columns else []


def splice_merge(target: DataFrame, source: DataFrame, spec: TableSpec, delivered: DataFrame | None = None) -> DataFrame:
    """The target after a delivery of any age: versions of the delivered keys are folded anew.

    ``source`` holds the audited rows of the new delivery, ``delivered`` those of earlier ones as far as they are
    kept, of any keys. Versions that a delivery no longer kept has opened take part as what was known then;
    without ``delivered`` all do, so that the new rows are placed between the versions, but a value that was only
    confirmed after them does not come back. Versions of other keys pass through. ``target`` may be a part of the
    table that is closed under the key. A source with two rows for a key is refused.
    """
    source = guarded(aligned(source, target), spec, spec.value_hash)
    kept = aligned(delivered, target) if delivered is not None else empty_of(target.sparkSession, target.schema)
    touched = source.groupBy(spec.key_hash).agg(F.count(F.lit(1)).alias("_rows"))
    kept = kept.join(touched, spec.key_hash, "left_semi")
    known = target.join(touched, spec.key_hash, "left_semi") \
        .join(kept.select(spec.key_hash, START), [spec.key_hash, START], "left_anti").select(*target.columns)
    folded = fold_versions(known.unionByName(kept).unionByName(source), spec)
    return target.join(touched, spec.key_hash, "left_anti").select(*target.columns).unionByName(folded)
