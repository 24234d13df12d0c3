"""Daily fact: key lookup, build, and the star around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.context import DIM_SYMBOL_SPEC, FACT_DAILY_SPEC, BatchContext, TableSpec
from candlelake.functions.dates import date_id
from candlelake.functions.keys import business_hash
from candlelake.operators.audit import add_audit_columns
from candlelake.operators.merge import fact_sync

PRICE_COLUMNS = ("Volume", "High", "Low", "Open", "Close")


def with_dim_key(silver: DataFrame, dim: DataFrame, spec: TableSpec = DIM_SYMBOL_SPEC) -> DataFrame:
    """Current daily rows with the surrogate key of their symbol; NULL where it is unknown.

    The join size decides its strategy: a small dimension is broadcast by the optimizer, a
    large one is shuffled with skewed symbols split at run time.
    """
    keyed = (silver.filter("__CurrentFlag")
             .withColumn("DateID", date_id(F.col("Date")))
             .withColumn(spec.key_hash, business_hash(spec)))
    keys = dim.filter("__CurrentFlag").select("SymbolSID", spec.key_hash)
    return keyed.join(keys, spec.key_hash, "left").select(
        "SymbolSID", spec.key_hash, *PRICE_COLUMNS, "DateID")


def covered_dates(source: DataFrame) -> Column | None:
    """Scope of a fact sync: the span of dates the source covers (one aggregate row)."""
    low, high = source.agg(F.min("DateID"), F.max("DateID")).head()
    return None if low is None else F.col("DateID").between(low, high)


def fact_source(silver: DataFrame, dim: DataFrame, batch: BatchContext,
                spec: TableSpec = FACT_DAILY_SPEC) -> DataFrame:
    """Facts of a load, ready to sync.

    Unknown symbols have no surrogate key, so all of them would share one fact key per day;
    the symbol's own business hash stands in for it. Strict mode lets them collide.
    """
    member = DIM_SYMBOL_SPEC.key_hash
    keyed = with_dim_key(silver, dim)
    facts = add_audit_columns(keyed.drop(member) if spec.strict else keyed, spec, batch)
    if spec.strict:
        return facts
    stand_in = F.coalesce(F.col("SymbolSID").cast("string"), F.col(member))
    key = F.sha2(F.concat_ws("|", stand_in, F.col("DateID")), 256)
    return facts.withColumn(spec.key_hash, key).drop(member)


def build_fact_daily(target: DataFrame, silver: DataFrame, dim: DataFrame, batch: BatchContext,
                     spec: TableSpec = FACT_DAILY_SPEC, scope: Column | None = None,
                     above: Column | None = None) -> DataFrame:
    source = fact_source(silver, dim, batch, spec)
    return fact_sync(target, source, spec, scope, id_column="TransactionSID", above=above)


def star(fact: DataFrame, dim_date: DataFrame, dim_symbol: DataFrame, month: str | None = None) -> DataFrame:
    """Fact with its two dimensions; facts without a match stay, under blank members.

    ``month`` names the column a stored fact is partitioned by, the calendar's ``YearMonth``. It then is part of
    the join, so that a condition on the calendar prunes partitions while the query runs.
    """
    if not month:
        return fact.join(dim_date, "DateID", "left").join(dim_symbol, "SymbolSID", "left")
    days = dim_date.withColumn(month, F.col("YearMonth"))
    return fact.join(days, ["DateID", month], "left").drop(month).join(dim_symbol, "SymbolSID", "left")
