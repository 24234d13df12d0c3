"""Responses to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candlelake import schemas
from candlelake.context import SILVER_SPEC, BatchContext, TableSpec
from candlelake.operators.audit import add_audit_columns
from candlelake.operators.conform import conform, convertible, unconvertible
from candlelake.operators.flatten import flatten_responses
from candlelake.operators.merge import scd_merge
from candlelake.sources.responses import accept


# A row without them has no place in the table.
REQUIRED = ("Symbol", "Date")


def flat_bronze(bronze: DataFrame) -> DataFrame:
    """Distinct daily rows of good responses, still as text."""
    return flatten_responses(bronze).dropDuplicates()


def flat_bars(responses: DataFrame) -> DataFrame:
    return flat_bronze(accept(responses))


def silver_source(flat: DataFrame, batch: BatchContext, spec: TableSpec = SILVER_SPEC) -> DataFrame:
    """Audited, typed rows; hashes are taken over the delivered text, before any cast."""
    audited = add_audit_columns(convertible(flat, schemas.SILVER, required=REQUIRED), spec, batch)
    return conform(audited, schemas.SILVER)


def rejected_bars(flat: DataFrame) -> DataFrame:
    """Rows with a value that does not fit the silver types, or without symbol or date, for quarantine."""
    return unconvertible(flat, schemas.SILVER, required=REQUIRED)


def build_silver(target: DataFrame, responses: DataFrame, batch: BatchContext,
                 spec: TableSpec = SILVER_SPEC) -> DataFrame:
    return scd_merge(target, silver_source(flat_bars(responses), batch, spec), spec, batch)
