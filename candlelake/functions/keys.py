"""Hash keys over business and tracked columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlelake.context import AUDIT_COLUMNS, TableSpec


def joined_hash(columns: Sequence[str], null_token: str | None = None) -> Column:
    """SHA-256 hex of the columns' text joined by ``|`` in the given order.

    ``concat_ws`` drops NULLs, so without a token ('a', NULL, 'b') and ('a', 'b') collide. So do values that
    hold the separator, ('a|b', 'c') and ('a', 'b|c'); keys that may hold it need another column to differ in.
    """
    parts = [F.col(name).cast("string") for name in columns]
    if null_token is not None:
        parts = [F.coalesce(part, F.lit(null_token)) for part in parts]
    return F.sha2(F.concat_ws("|", *parts), 256)


def tracked_columns(columns: Iterable[str], spec: TableSpec) -> list[str]:
    """Columns whose change opens a new version, alphabetically."""
    return sorted(set(columns) - AUDIT_COLUMNS - set(spec.type1_columns))


def business_hash(spec: TableSpec) -> Column:
    return joined_hash(spec.business_columns, spec.null_token)


def change_hash(columns: Iterable[str], spec: TableSpec) -> Column:
    return joined_hash(tracked_columns(columns, spec), spec.null_token)


def type1_hash(spec: TableSpec) -> Column:
    """Hash of the overwrite-in-place columns; a constant when there are none."""
    names = sorted(set(spec.type1_columns)) if spec.table_type == "Fact" else spec.type1_columns
    return joined_hash(names, spec.null_token)
