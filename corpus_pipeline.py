"""Corpus pipeline: toxic documents go, copies and near copies go, sources are mixed, the rest is encoded.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlelake.llm import exact, mixing, pieces, simhash, toxicity
from candlelake.llm.common import passing, staged, table
from candlelake.llm.queries import piece_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Trained classifiers, hashes and piece models are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, text, ids, decoded`` of every row of the mix: its ids, and the text they decode to."""
    return pieces.encode_texts(docs, piece_model()).select(
        "row.doc_id", "row.source", "row.text", "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages but the last are written; what a stage stages for itself goes when its rows are written.

    Every stage defines what it does with nulls, empty and long texts, ties, repeated rows and columns of any
    name: rows come through with all their columns, an empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with passing(spark):
            docs = staged(stage(spark, docs, sf_dir), f"stage-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
