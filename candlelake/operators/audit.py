"""Audit columns of the three table types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.context import BatchContext, TableSpec
from candlelake.functions.keys import business_hash, change_hash, type1_hash

# Fixed value: end stamp of a version that is still open.
OPEN_END = "2099-12-31 00:00:00"


def at(stamp: str) -> Column:
    return F.lit(stamp).cast("timestamp")


def _created(batch: BatchContext) -> dict[str, Column]:
    return {"__CreatedBatchLogId": F.lit(batch.batch_id), "__CreateDateTime": at(batch.start)}


def _version(batch: BatchContext) -> dict[str, Column]:
    return {
        "__CurrentFlag": F.lit(True),
        "__DeletedFlag": F.lit(False),
        "__EffectiveStartDateTime": at(batch.start),
        "__EffectiveEndDateTime": at(OPEN_END),
        "__UpdatedBatchLogId": F.lit(None).cast("string"),
        "__UpdateDateTime": F.lit(None).cast("timestamp"),
        **_created(batch),
    }


def audit_columns(columns: list[str], spec: TableSpec, batch: BatchContext) -> dict[str, Column]:
    match spec.table_type:
        case "Stage":
            return {**_version(batch),
                    "__lastmodified": at(batch.start),
                    "__HashKey": business_hash(spec),
                    "__HashValue": change_hash(columns, spec)}
        case "Dim":
            return {**_version(batch),
                    "__BusinessKeyHash": business_hash(spec),
                    "__Hash1Type": type1_hash(spec),
                    "__Hash2Type": change_hash(columns, spec)}
        case _:
            return {"__DeletedFlag": F.lit(False),
                    "__FactKeyHash": business_hash(spec),
                    "__FactSCD1Hash": type1_hash(spec),
                    **_created(batch)}


def add_audit_columns(df: DataFrame, spec: TableSpec, batch: BatchContext) -> DataFrame:
    """All audit columns of the table type in one projection."""
    return df.withColumns(audit_columns(df.columns, spec, batch))
