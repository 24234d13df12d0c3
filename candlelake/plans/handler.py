"""A versioned load configured by a parameter dictionary."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame

from candlelake.context import BatchContext, TableSpec
from candlelake.operators.audit import add_audit_columns
from candlelake.operators.merge import fact_sync, scd_merge


class VersionedLoad:
    """Audit columns and merge of one table, under one batch id.

    ``params`` is ``{businessColumns, typeIColumns, tableType}`` with comma-separated columns.
    """

    def __init__(self, params: dict[str, str], strict: bool = False, batch: BatchContext | None = None):
        self.spec = TableSpec.from_params(params, strict)
        self.batch = batch or BatchContext()

    def refresh_timestamp(self) -> None:
        """Move the clock to now; the batch id stays."""
        self.batch = replace(self.batch, effective_ts=BatchContext().effective_ts)

    def add_audit_columns(self, df: DataFrame) -> DataFrame:
        return add_audit_columns(df, self.spec, self.batch)

    def merge(self, target: DataFrame, source: DataFrame, id_column: str | None = None,
              scope: Column | None = None) -> DataFrame:
        """The table after the load; ``scope`` limits which facts an incomplete source may delete."""
        if self.spec.table_type == "Fact":
            return fact_sync(target, source, self.spec, scope, id_column)
        return scd_merge(target, source, self.spec, self.batch, id_column)
