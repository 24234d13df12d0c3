"""Writing tables: partition overwrite, appends, schema evolution, catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake import schemas


def _clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a partition value next to each other, in evenly sized tasks.

    A rebalance, not a repartition: a value with a third of all rows is split over several
    tasks, small values share one, and each task opens few files.
    """
    return df.hint("rebalance", *columns)


def overwrite_partitions(df: DataFrame, path: str, column: str = "symbol") -> None:
    """Replace only the partitions present in the batch."""
    (_clustered(df, column).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))


def append_by(df: DataFrame, path: str, column: str = "symbol") -> None:
    """Add the batch to its partitions in a single write. Running it twice stores the rows twice."""
    _clustered(df, column).write.mode("append").partitionBy(column).parquet(path)


def append_by_symbol(responses: DataFrame, path: str) -> None:
    """Each symbol's responses into its own folder."""
    append_by(responses.withColumn("symbol", F.col("meta.symbol")), path)


def overwrite_evolving(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace the whole table, partitioned if wanted; the new schema may add columns."""
    rows = _clustered(df, partition_by) if partition_by else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .parquet(path, partitionBy=[partition_by] if partition_by else None)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows that may carry new columns; :func:`read_evolving` merges the schemas."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def create_table(spark: SparkSession, name: str, ddl: str, path: str, replace: bool = False,
                 partition_by: str | None = None) -> None:
    """Catalog table with a declared schema at a location; an existing one stays unless replaced.

    A replaced table starts empty in a new folder beside the old one, whose files stay for running readers.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = f"{path.rstrip('/')}-{uuid.uuid4().hex[:8]}"
    partitioned = f" PARTITIONED BY ({partition_by})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING PARQUET{partitioned} LOCATION '{path}'")


def create_known_table(spark: SparkSession, name: str, path: str, kind: str, replace: bool = False) -> None:
    create_table(spark, name, schemas.TABLES[kind], path, replace)


def empty_like(spark: SparkSession, df: DataFrame) -> DataFrame:
    """No rows, same schema: what a table is reset to."""
    return schemas.empty_of(spark, df.schema)


def switch_location(spark: SparkSession, name: str, df: DataFrame, path: str) -> None:
    """Write a new snapshot of a table that may be read by ``df`` itself, then point to it."""
    df.write.mode("errorifexists").parquet(path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def replace_partitions(spark: SparkSession, name: str, df: DataFrame, column: str, scope: Iterable[int],
                       path: str, sort_by: Sequence[str] = (),
                       before_switch: Callable[[DataFrame], None] | None = None, clustered: bool = False) -> None:
    """Make ``df`` the content of the partitions in ``scope`` of a catalog table.

    The new files go to a folder of their own; only then is each partition pointed there, and
    those left without rows are dropped last. ``df`` may read the table itself, a failed write
    leaves it as it was, a partition always holds either its old or its new rows, and no other
    partition is touched. ``scope`` lists the partitions of one load, bounded by the calendar.
    Files are sorted by ``sort_by``, so that filters on it skip most row groups. ``before_switch``
    gets the written rows before any partition points to them. ``clustered`` rows are written as they are dealt.
    """
    scope = set(scope)
    if not scope:
        return
    ((df if clustered else _clustered(df, column)).sortWithinPartitions(column, *sort_by)
     .write.partitionBy(column).parquet(path))
    if before_switch:
        before_switch(spark.read.schema(df.schema).parquet(path))
    filled = {row[0] for row in _partition_values(spark, path, column)}
    held = {int(row[0].split("=")[1]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new = [f"PARTITION ({column} = {value}) LOCATION '{path}/{column}={value}'" for value in sorted(filled - held)]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(new)}")
    for value in sorted(filled & held):
        spark.sql(f"ALTER TABLE {name} PARTITION ({column} = {value}) SET LOCATION '{path}/{column}={value}'")
    emptied = [f"PARTITION ({column} = {value})" for value in sorted((scope & held) - filled)]
    if emptied:
        spark.sql(f"ALTER TABLE {name} DROP {', '.join(emptied)}")
    spark.catalog.refreshTable(name)


def _partition_values(spark: SparkSession, path: str, column: str) -> list:
    """Partition values below a folder; answered from folder names alone."""
    return spark.read.schema(f"{column} INT").parquet(path).select(column).distinct().collect()


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
