"""Aligning rows with a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlelake.schemas import schema_of


def _target(ddl: str | StructType, skip: tuple[str, ...]) -> StructType:
    schema = ddl if isinstance(ddl, StructType) else schema_of(ddl)
    return StructType([field for field in schema.fields if field.name not in skip])


def conform(df: DataFrame, ddl: str | StructType, skip: tuple[str, ...] = ()) -> DataFrame:
    """Cast every column to the table's type; absent columns are NULL, ``skip`` drops id columns.

    Values that do not convert become NULL; :func:`unconvertible` finds them first.
    """
    have = {name.lower() for name in df.columns}
    return df.select(*(
        (F.col(field.name).try_cast(field.dataType) if field.name.lower() in have
         else F.lit(None).cast(field.dataType)).alias(field.name)
        for field in _target(ddl, skip).fields))


def _fails(df: DataFrame, ddl: str | StructType, skip: tuple[str, ...], required: tuple[str, ...]) -> Column:
    have = {field.name.lower(): field.dataType for field in df.schema.fields}
    failing = F.lit(False)
    for name in required:
        failing = failing | F.col(name).isNull()
    for field in _target(ddl, skip).fields:
        if have.get(field.name.lower(), field.dataType) != field.dataType:
            value = F.col(field.name)
            failing = failing | (value.isNotNull() & value.try_cast(field.dataType).isNull())
    return failing


def unconvertible(df: DataFrame, ddl: str | StructType, skip: tuple[str, ...] = (),
                  required: tuple[str, ...] = ()) -> DataFrame:
    """Rows with a value that does not convert to the table's type, or without a required one."""
    return df.filter(_fails(df, ddl, skip, required))


def convertible(df: DataFrame, ddl: str | StructType, skip: tuple[str, ...] = (),
                required: tuple[str, ...] = ()) -> DataFrame:
    return df.filter(~_fails(df, ddl, skip, required))


def add_columns(df: DataFrame, ddl: str) -> DataFrame:
    """Add declared columns to a table; existing rows hold NULL, existing columns stay."""
    have = {name.lower() for name in df.columns}
    return df.withColumns({field.name: F.lit(None).cast(field.dataType)
                           for field in schema_of(ddl).fields if field.name.lower() not in have})
