"""Vendor responses: landed documents, acceptance, bronze files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake import schemas


def read_landed(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per landed JSON document; the declared schema also covers an empty folder.

    A document is a line, or with ``multi_line`` a file, which may be indented. The text of a broken
    document stays in ``_corrupt_record``.
    """
    return spark.read.schema(schemas.LANDED).option("multiLine", multi_line).json(path)


def is_accepted() -> Column:
    return F.coalesce(F.col("meta").isNotNull() & (F.col("status") == "ok"), F.lit(False))


def accept(responses: DataFrame) -> DataFrame:
    """Good responses with their symbol lifted out of the metadata."""
    return (responses.filter(is_accepted())
            .withColumn("symbol", F.col("meta").getItem("symbol"))
            .drop("status", schemas.BROKEN))


def reject(responses: DataFrame) -> DataFrame:
    """The complement of :func:`accept`, for a quarantine folder."""
    return responses.filter(~is_accepted())


def read_bronze(spark: SparkSession, path: str, symbols: DataFrame | None = None) -> DataFrame:
    """Responses partitioned by symbol, without the partition column; all or those of some symbols.

    The schema is declared so that a numeric-looking symbol stays text.
    """
    bronze = spark.read.schema(schemas.BRONZE).parquet(path)
    if symbols is not None:
        wanted = symbols.select(F.col("symbol").alias("_wanted")).distinct()
        bronze = bronze.join(wanted, F.col("symbol").eqNullSafe(F.col("_wanted")), "left_semi")
    return bronze.drop("symbol")


def read_below(spark: SparkSession, path: str) -> DataFrame:
    """Every parquet file below ``path``, whatever the folder layout."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)
