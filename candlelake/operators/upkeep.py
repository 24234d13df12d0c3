"""Upkeep of stored tables: few files of a good size, and no folders nobody points to."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.operators.sinks import replace_partitions

TARGET_BYTES = 128 << 20


def symbol_bucket(column: str, buckets: int) -> Column:
    """The folder of a key when thousands of keys share one: its hash, the same in every delivery."""
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def append_hashed(df: DataFrame, name: str, column: str, buckets: int, bucket_column: str = "Bucket") -> None:
    """Append a delivery to a catalog table partitioned by the hash of a key.

    ``name`` has the columns of ``df`` and ``bucket_column`` last. A delivery adds a file or two to the folders it
    touches; :func:`compact` packs them.
    """
    df.withColumn(bucket_column, symbol_bucket(column, buckets)).hint("rebalance", bucket_column) \
        .write.insertInto(name)


def files_of(spark: SparkSession, name: str, column: str) -> DataFrame:
    """Files of a partitioned table with their partition value and size."""
    return spark.table(name).select(
        F.col(column), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct()


def compact(spark: SparkSession, name: str, column: str, path: str, target_bytes: int = TARGET_BYTES,
            sort_by: tuple[str, ...] = ()) -> list[int]:
    """Rewrite the partitions that have more files than their bytes need; returns them.

    A partition gets as many files as its bytes fill, at least one; its rows are dealt to them by their own hash,
    so that a large partition is written by several tasks. New files go to ``path``, the old ones stay for
    running readers until they are swept. Other partitions keep their files.
    """
    sizes = files_of(spark, name, column).groupBy(column).agg(
        F.count(F.lit(1)).alias("_files"), F.sum("bytes").alias("_bytes"))
    wanted = F.greatest(F.ceil(F.col("_bytes") / F.lit(target_bytes)), F.lit(1))
    crowded = sizes.withColumn("_wanted", wanted).filter("_files > _wanted").select(column, "_wanted").collect()
    if not crowded:
        return []
    files = {row[0]: row[1] for row in crowded}  # one entry per folder of the table
    rows = spark.table(name)
    number = F.element_at(F.create_map(*(F.lit(x) for pair in files.items() for x in pair)), F.col(column))
    dealt = [field.name for field in rows.schema.fields
             if field.name != column and "map<" not in field.dataType.simpleString()]
    packed = rows.filter(F.col(column).isin(list(files))).withColumn("_file", F.pmod(F.xxhash64(*dealt), number)) \
        .repartition(column, "_file").drop("_file")
    replace_partitions(spark, name, packed, column, files, path, sort_by, clustered=True)
    return sorted(files)


# -- folders nobody points to ---------------------------------------------------------------

def live_locations(spark: SparkSession, names: Iterable[str]) -> set[str]:
    """Folders the catalog points to: of tables, and of partitions where a table has them."""
    found = set()

    def described(what: str) -> list:
        rows = spark.sql(f"DESCRIBE EXTENDED {what}").collect()
        # a partition is described with its own location and its table's
        found.update(row["data_type"] for row in rows if row["col_name"] == "Location")
        return rows

    for name in names:
        if any(row["col_name"] == "# Partition Information" for row in described(name)):
            for part in spark.sql(f"SHOW PARTITIONS {name}").collect():
                spec = ", ".join(f"{key}='{value}'" for key, value in (piece.split("=") for piece in part[0].split("/")))
                described(f"{name} PARTITION ({spec})")
    return found


def _plain(spark: SparkSession, location: str) -> str:
    """A location without scheme and trailing slash, as listings give it."""
    return spark._jvm.org.apache.hadoop.fs.Path(location).toUri().getPath().rstrip("/")


def older_folders(spark: SparkSession, folder: str, before: datetime) -> list[str]:
    """Folders directly below one that were last written before a time; partitions of the folder itself are not."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    limit = before.replace(tzinfo=before.tzinfo or timezone.utc).timestamp() * 1000
    if not files.exists(root):
        return []
    return [_plain(spark, status.getPath().toString()) for status in files.listStatus(root)
            if status.isDirectory() and status.getModificationTime() < limit
            and "=" not in status.getPath().getName() and not status.getPath().getName().startswith("_")]


def sweep(spark: SparkSession, folders: Iterable[str], live: Iterable[str], before: datetime) -> list[str]:
    """Delete the folders directly below ``folders`` that hold no live location and are older than a time.

    The age protects readers that began under an older pointer, and loads that have written but not yet
    published. Returns what was deleted.
    """
    kept = {_plain(spark, location) for location in live}
    gone = []
    for folder in folders:
        for place in older_folders(spark, folder, before):
            if not any(f"{location}/".startswith(f"{place}/") for location in kept):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder, place.rsplit("/", 1)[1])
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
                gone.append(place)
    return gone
