"""Versioned tables stored in buckets of their key, merged without moving them.

A bucketed table lies dealt by the hash of its key. A delivery is dealt into the same number of buckets and
joined with it bucket by bucket: only the delivery is shuffled, and the merged rows are written back from where
they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from candlelake.context import BatchContext, TableSpec
from candlelake.operators.merge import scd_merge


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """A catalog table at ``path``, dealt and sorted by ``key``; rows already dealt so are not shuffled."""
    df.write.format("parquet").mode("errorifexists").bucketBy(buckets, key).sortBy(key) \
        .option("path", path).saveAsTable(name)


def create_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """First content of a bucketed table; every task writes whole buckets."""
    write_bucketed(df.repartition(buckets, key), name, path, key, buckets)


def bucketing(spark: SparkSession, name: str) -> tuple[int, str]:
    """Number of buckets and key column of a table."""
    found = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "Num Buckets" not in found:
        raise ValueError(f"table {name} has no buckets")
    return int(found["Num Buckets"]), found["Bucket Columns"].strip("[]`")


def merged_buckets(spark: SparkSession, name: str, source: DataFrame, spec: TableSpec, batch: BatchContext) -> DataFrame:
    """The table after a delivery; the stored side is scanned once and has no exchange above it.

    The number of buckets is the number of tasks: choose it so that a bucket fits an executor's memory.
    """
    buckets, key = bucketing(spark, name)
    if key != spec.key_hash:
        raise ValueError(f"table {name} is dealt by {key}, not by {spec.key_hash}")
    return scd_merge(spark.table(name), source.repartition(buckets, key), spec, batch, one_scan=True)


def merge_buckets(spark: SparkSession, name: str, source: DataFrame, spec: TableSpec, batch: BatchContext,
                  path: str) -> None:
    """Merge a delivery into a bucketed table; its new files go to ``path``, the old ones stay for running readers."""
    buckets, key = bucketing(spark, name)
    passing = f"{name}_{uuid.uuid4().hex[:8]}"
    write_bucketed(merged_buckets(spark, name, source, spec, batch), passing, path, key, buckets)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.sql(f"DROP TABLE {passing}")
    spark.catalog.refreshTable(name)
