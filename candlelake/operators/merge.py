"""Merges of a loaded batch into a versioned table, as one join pass each.

Every function returns the complete new table. Closed versions never take part in a join:
they pass straight through, so a key with a long history costs no more than a new one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.context import BatchContext, TableSpec
from candlelake.operators.audit import at
from candlelake.operators.surrogate import fresh_id, highest_id, number_missing


def is_current() -> Column:
    return F.coalesce(F.col("__CurrentFlag"), F.lit(False))


def aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source in the target's column order and types; columns it lacks are NULL."""
    have = set(source.columns)
    return source.select(*(
        (F.col(field.name).cast(field.dataType) if field.name in have
         else F.lit(None).cast(field.dataType)).alias(field.name)
        for field in target.schema.fields))


# -- the three sides of a merge -------------------------------------------------------------

def matched_changes(target: DataFrame, source: DataFrame, spec: TableSpec) -> DataFrame:
    """Current target rows whose key arrives with a different change hash."""
    pairs = source.select(F.col(spec.key_hash), F.col(spec.value_hash).alias("_new_value"))
    return (target.filter(is_current()).join(pairs, spec.key_hash)
            .filter(F.col(spec.value_hash) != F.col("_new_value"))
            .withColumnRenamed("_new_value", "NewHash"))


def not_matched(target: DataFrame, source: DataFrame, spec: TableSpec) -> DataFrame:
    """Source rows without a current target row."""
    current = target.filter(is_current()) if "__CurrentFlag" in target.columns else target
    return source.join(current.select(spec.key_hash), spec.key_hash, "left_anti")


def not_matched_by_source(target: DataFrame, source: DataFrame, spec: TableSpec) -> DataFrame:
    """Target rows whose key is absent from the source."""
    return target.join(source.select(spec.key_hash), spec.key_hash, "left_anti")


def changed_rows(target: DataFrame, source: DataFrame, spec: TableSpec) -> DataFrame:
    """Source rows that are new or differ from their current target row."""
    hashes = [spec.key_hash, spec.value_hash]
    if spec.table_type == "Dim" and spec.type1_columns:
        hashes.append("__Hash1Type")
    current = target.filter(is_current()) if "__CurrentFlag" in target.columns else target
    return source.join(current.select(*hashes), hashes, "left_anti")


def differing(target: DataFrame, source: DataFrame, spec: TableSpec, part: Column) -> DataFrame:
    """Distinct values of ``part`` over rows that are new, changed or gone, from one join of narrow rows."""
    sides = [side.select(spec.key_hash, spec.value_hash, part.alias("part")) for side in (target, source)]
    pairs = _joined(*sides, spec, "full_outer")
    same = F.col(f"t.{spec.value_hash}").eqNullSafe(F.col(f"s.{spec.value_hash}"))
    return pairs.filter(~same).select(F.coalesce("t.part", "s.part").alias("part")).distinct()


def insert_only(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Append the source rows whose key the target does not hold yet."""
    new = source.join(target.select(*on), list(on), "left_anti")
    return target.unionByName(aligned(new, target))


# -- source check ---------------------------------------------------------------------------

def duplicate_keys(source: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys that more than one source row claims; counted map-side first."""
    return (source.groupBy(spec.key_hash).agg(F.count(F.lit(1)).alias("RowCount"))
            .filter(F.col("RowCount") > 1))


def check_source(source: DataFrame, spec: TableSpec) -> DataFrame:
    """The source itself, or an error naming a key that would hit a target row twice."""
    worst = duplicate_keys(source, spec).limit(1).collect()
    if worst:
        raise ValueError(f"merge source holds {worst[0]['RowCount']} rows for key {worst[0][0]}")
    return source


def guarded(source: DataFrame, spec: TableSpec, column: str) -> DataFrame:
    """The source, failing while it is read if two rows share a key; ``column`` must be one the merge uses.

    Rows are counted within the partitioning the merge joins on, so the check costs no shuffle.
    """
    rows = F.count(F.lit(1)).over(Window.partitionBy(spec.key_hash))
    problem = F.concat(F.lit("merge source holds "), F.col("_rows").cast("string"), F.lit(" rows for key "),
                       F.col(spec.key_hash))
    checked = F.when(F.col("_rows") > 1, F.raise_error(problem).cast("string")).otherwise(F.col(column))
    return source.withColumn("_rows", rows).withColumn(column, checked).drop("_rows")


# -- slowly changing versions ---------------------------------------------------------------

def _side(side: str, columns: list[str]) -> dict[str, Column]:
    return {name: F.col(f"{side}.{name}") for name in columns}


def _joined(target: DataFrame, source: DataFrame, spec: TableSpec, how: str, current_only: bool = False) -> DataFrame:
    same = F.col(f"t.{spec.key_hash}") == F.col(f"s.{spec.key_hash}")
    if current_only:
        same &= F.coalesce(F.col("t.__CurrentFlag"), F.lit(False))
    return target.alias("t").join(source.alias("s"), same, how)


def _type1_changed(spec: TableSpec) -> Column:
    if spec.table_type != "Dim" or not spec.type1_columns:
        return F.lit(False)
    return F.coalesce(F.col("t.__Hash1Type") != F.col("s.__Hash1Type"), F.lit(False))


def _overwritten(spec: TableSpec) -> list[str]:
    """Columns the overwrite step takes from the source; strict mode leaves the stored hash stale."""
    if spec.table_type != "Dim" or not spec.type1_columns:
        return []
    return [*spec.type1_columns] + ([] if spec.strict else ["__Hash1Type"])


def _kept(columns: list[str], spec: TableSpec, batch: BatchContext, expire: Column) -> list[Column]:
    """The stored row after the batch: type-1 values overwritten, closed where a new version opens."""
    overwrite = _type1_changed(spec)
    late = F.concat(F.lit(f"batch {batch.batch_id} is older than the current version of key "),
                    F.col(f"t.{spec.key_hash}"), F.lit("; it needs splice_merge"))
    end = F.when(F.col("t.__EffectiveStartDateTime") > at(batch.start), F.raise_error(late).cast("timestamp")) \
        .otherwise(at(batch.end))
    changes = {
        "__CurrentFlag": (expire, F.lit(False)),
        "__EffectiveEndDateTime": (expire, end),
        "__lastmodified": (expire, at(batch.start)),
        "__UpdatedBatchLogId": (expire | overwrite, F.lit(batch.batch_id)),
        "__UpdateDateTime": (expire | overwrite, at(batch.start)),
        **{name: (overwrite, F.col(f"s.{name}")) for name in _overwritten(spec)},
    }
    kept = []
    for name, stored in _side("t", columns).items():
        when, value = changes.get(name, (None, None))
        kept.append((stored if when is None else F.when(when, value).otherwise(stored)).alias(name))
    return kept


def scd_merge(target: DataFrame, source: DataFrame, spec: TableSpec, batch: BatchContext,
              id_column: str | None = None, above: Column | None = None, one_scan: bool = False) -> DataFrame:
    """Type-1 overwrite, type-2 expiry and insertion in one full outer join.

    ``target`` may be the whole table or any part of it that is closed under the business
    key (for example the date partitions a batch touches). Rows missing from the source are
    left alone. A source with two rows for a key is refused, and so is a change older than the version
    it would close (:func:`candlelake.operators.history.splice_merge` takes those). With ``id_column`` the inserted rows,
    known only after the join, are numbered without gaps (above ``above``, by default the target's
    highest id). With ``one_scan`` closed versions go through the join unmatched instead of past it: right for
    a target that lies dealt by its key.
    """
    columns = target.columns
    source = guarded(aligned(source, target), spec, spec.value_hash)
    pairs = _joined(target if one_scan else target.filter(is_current()), source, spec, "full_outer", one_scan)
    has_target = F.col(f"t.{spec.key_hash}").isNotNull()
    has_source = F.col(f"s.{spec.key_hash}").isNotNull()
    expire = F.coalesce(F.col(f"t.{spec.value_hash}") != F.col(f"s.{spec.value_hash}"), F.lit(False))
    kept = F.when(has_target, F.struct(*_kept(columns, spec, batch, expire)))
    opened = F.when(has_source & (~has_target | expire),
                    F.struct(*(column.alias(name) for name, column in _side("s", columns).items())))
    merged = pairs.select(F.inline(F.array_compact(F.array(kept, opened))))
    if id_column:
        top = above if above is not None else highest_id(target, id_column)
        merged = number_missing(merged, id_column, F.col(spec.key_hash), top)
    return merged if one_scan else target.filter(~is_current()).unionByName(merged)


def type1_update(target: DataFrame, source: DataFrame, spec: TableSpec, batch: BatchContext) -> DataFrame:
    """Only the overwrite step: current rows take the source's type-1 values."""
    if not spec.type1_columns:
        return target
    narrow = guarded(source.select(spec.key_hash, "__Hash1Type", *spec.type1_columns), spec, "__Hash1Type")
    pairs = _joined(target.filter(is_current()), narrow, spec, "left")
    updated = pairs.select(*_kept(target.columns, spec, batch, expire=F.lit(False)))
    return target.filter(~is_current()).unionByName(updated)


# -- fact synchronisation -------------------------------------------------------------------

def fact_sync(target: DataFrame, source: DataFrame, spec: TableSpec, scope: Column | None = None,
              id_column: str | None = None, above: Column | None = None) -> DataFrame:
    """Replace changed facts, drop vanished ones, insert new ones in one full outer join.

    ``scope`` is a condition on key columns that every source row meets; facts outside it are
    neither joined nor deleted. Without it the source counts as the complete fact table.
    A strict spec only deletes a changed fact, which then returns with the next load. A source with
    two rows for a key is refused. With ``id_column`` inserted facts get a fresh id after the join.
    """
    columns = target.columns
    source = guarded(aligned(source, target), spec, spec.value_hash)
    inside = target
    if scope is not None:
        inside = target.filter(F.coalesce(scope, F.lit(False)))
    pairs = _joined(inside, source, spec, "full_outer")
    same = F.coalesce(F.col(f"t.{spec.value_hash}") == F.col(f"s.{spec.value_hash}"), F.lit(False))
    fresh = F.col(f"t.{spec.key_hash}").isNull() if spec.strict else ~same
    keep_new = F.col(f"s.{spec.key_hash}").isNotNull() & fresh
    stored, arriving = _side("t", columns), _side("s", columns)
    if id_column:
        arriving[id_column] = fresh_id(above if above is not None else highest_id(target, id_column))
    synced = pairs.filter(same | keep_new).select(*(
        F.when(same, stored[name]).otherwise(arriving[name]).alias(name) for name in columns))
    if scope is not None:
        synced = target.filter(~F.coalesce(scope, F.lit(False))).unionByName(synced)
    return synced
