from __future__ import annotations

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOCUMENTS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType())])
#: Names the operators use themselves.
CLASHING = ("row", "print", "size", "key", "of", "id", "at", "body", "kept", "ids", "copies", "score", "range", "spots")


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``, with columns of clashing names."""
    def build(rows, clashing=True, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        names = CLASHING if clashing else ()
        schema = StructType([*DOCUMENTS.fields, *(StructField(n, IntegerType()) for n in names)])
        return spark.createDataFrame([(*r, *([7] * len(names))) for r in full], schema).repartition(parts)
    return build


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """Whole texts of the sample table by id."""
    return {row.doc_id: row.text or "" for row in documents.select("doc_id", "text").collect()}


#: Nulls, empty and blank texts, repeated rows, ties in id, one very long text.
ODD = [
    (None, "a b c d e f"), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "Same  text\there"),
    (5, "Same text here"), (5, "Same text here"), (6, "Same text here "), (7, "ünïcødé 日本語 🙂 x@y.zz"), (7, "other"),
    (8, "w " * 30_000), (9, "word"), (10, "z" * 50_000), (11, "\0 a▁b  c"),
]
