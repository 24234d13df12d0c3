"""Exact deduplication through counting quotient filters.

Texts are equal when they are identical after every run of ASCII white space became one space. Each
task puts the fingerprints of its rows into counting quotient filters, one per block of the
fingerprint range: the high bits pick a slot, the sorted remainders of a slot form its run, and a
counter follows a remainder that came more than once. Remainders and slot give the whole 64 bits back,
so filters of one block merge without loss: their runs are merged in order and the counters added.
Fingerprints whose merged count is above one are marked in a bitmap of bounded size; rows that hit it
are verified byte by byte (grouped by fingerprint and whole normalised text), all others are known to
be unique and never move. A bitmap that fills up only sends more rows to the verification.

A null text counts as empty. The row with the smallest ``doc_id`` of a group stays, a null id counting
as the largest; of repeated rows with the same id exactly one stays. Columns are kept whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.llm.common import SPACE, shuffle_parts, staged, text_or_empty

BITMAP_BITS = 1 << 27
BITMAP_PIECE = 1 << 16
HASHES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class QuotientFilter:
    """Counting quotient filter over fingerprints that share their first ``skip`` bits."""

    def __init__(self, prints: np.ndarray, counts: np.ndarray):
        self.prints, self.counts = prints, counts

    @classmethod
    def of(cls, prints: np.ndarray) -> QuotientFilter:
        return cls(*np.unique(prints, return_counts=True))

    @classmethod
    def merge(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """Sorted runs are merged, counters of equal fingerprints added."""
        prints = np.concatenate([x.prints for x in filters])
        counts = np.concatenate([x.counts for x in filters])
        order = np.argsort(prints, kind="stable")
        prints, counts = prints[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
        return cls(prints[first], np.add.reduceat(counts, first))

    def pack(self, skip: int) -> bytes:
        """Slot bits for occupied quotients, run lengths, remainders, and the counters above one."""
        slots = max(1, int(self.prints.size - 1).bit_length())
        rest = 64 - skip - slots
        inside = self.prints & np.uint64((1 << (64 - skip)) - 1)
        quotient = (inside >> np.uint64(rest)).astype(np.int64)
        occupied, runs = np.unique(quotient, return_counts=True)
        bits = np.zeros(1 << slots, np.uint8)
        bits[occupied] = 1
        width = (rest + 7) // 8
        remainder = (inside & np.uint64((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        many = np.flatnonzero(self.counts > 1)
        head = np.array([slots, self.prints.size, occupied.size, many.size, self.prints[0] >> np.uint64(64 - skip)],
                        np.uint64)
        return b"".join(x.tobytes() for x in (
            head, np.packbits(bits), runs.astype(np.uint32), np.ascontiguousarray(remainder),
            many.astype(np.uint32), self.counts[many].astype(np.uint64)))

    @classmethod
    def unpack(cls, data: bytes, skip: int) -> QuotientFilter:
        slots, size, used, many, block = (int(x) for x in np.frombuffer(data, np.uint64, 5))
        rest, at = 64 - skip - slots, 40

        def take(kind: type, n: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(data, kind, n, at)
            at += part.nbytes
            return part

        occupied = np.flatnonzero(np.unpackbits(take(np.uint8, ((1 << slots) + 7) // 8), count=1 << slots))
        quotient = np.repeat(occupied, take(np.uint32, used)).astype(np.uint64)
        width = (rest + 7) // 8
        remainder = np.zeros((size, 8), np.uint8)
        remainder[:, :width] = take(np.uint8, size * width).reshape(size, width)
        counts = np.ones(size, np.int64)
        where = take(np.uint32, many)
        counts[where] = take(np.uint64, many).astype(np.int64)
        prints = (np.uint64(block) << np.uint64(64 - skip)) | (quotient << np.uint64(rest))
        return cls(prints | remainder.view("<u8").ravel(), counts)


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def block_bits(spark: SparkSession) -> int:
    """Blocks follow the number of shuffle partitions, so a block's size does not grow with the data."""
    return max(1, math.ceil(math.log2(shuffle_parts(spark)))) + 1


def first_column(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        yield batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def repeated_prints(rows: DataFrame, prints_of: Callable[..., Iterator[np.ndarray]] = first_column) -> DataFrame:
    """``print``: the fingerprints that occur more than once, by filters built and merged.

    ``prints_of`` gives the fingerprints of a task's batches, by default those in the first column.
    """
    bits = block_bits(rows.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [prints for prints in prints_of(batches) if prints.size]
        if not parts:
            return
        whole = QuotientFilter.of(np.concatenate(parts))
        block = whole.prints >> np.uint64(64 - bits)
        edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        pairs = list(zip(edges[:-1], edges[1:], strict=True))
        yield pa.RecordBatch.from_arrays([
            pa.array(block[edges[:-1]].astype(np.int32)),
            pa.array([QuotientFilter(whole.prints[a:b], whole.counts[a:b]).pack(bits) for a, b in pairs], pa.binary()),
        ], ["block", "filter"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        merged = QuotientFilter.merge([QuotientFilter.unpack(data, bits) for data in frame["filter"]])
        return pd.DataFrame({"print": merged.prints[merged.counts > 1].view(np.int64)})

    return rows.mapInArrow(build, "block int, filter binary").groupBy("block").applyInPandas(merge, "print long")


def _positions(prints: np.ndarray, bits: int) -> list[np.ndarray]:
    shift = np.uint64(64 - int(bits).bit_length() + 1)
    return [((prints.view(np.uint64) * factor) >> shift).astype(np.int64) for factor in HASHES]


def bitmap_of(prints: DataFrame, most: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap with two bits per fingerprint, ``most`` bits at the most, combined piece by piece."""
    bits = 1 << min(most.bit_length() - 1, max(16, (16 * prints.count()).bit_length()))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(bits, bool)
        for batch in batches:
            for at in _positions(batch.column(0).to_numpy(zero_copy_only=False), bits):
                whole[at] = True
        pieces = whole.reshape(-1, min(bits, BITMAP_PIECE))
        used = np.flatnonzero(pieces.any(axis=1))
        yield pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()),
            pa.array([np.packbits(pieces[i]).tobytes() for i in used], pa.binary())], ["piece", "data"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        data = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in frame["data"]])
        return pd.DataFrame({"piece": frame["piece"][:1], "data": [data.tobytes()]})

    pieces = prints.mapInArrow(build, "piece int, data binary") \
        .groupBy("piece").applyInPandas(merge, "piece int, data binary")
    out = np.zeros((max(1, bits // BITMAP_PIECE), min(bits, BITMAP_PIECE) // 8), np.uint8)
    for piece, data in pieces.toLocalIterator():
        out[piece] = np.frombuffer(bytes(data), np.uint8)
    return out.ravel()


def in_bitmap(prints: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Which fingerprints can be among those of the bitmap; none of those is missed."""
    found = np.ones(prints.size, bool)
    for at in _positions(prints, bitmap.size * 8):
        found &= (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return found


def may_repeat(spark: SparkSession, bitmap: np.ndarray) -> Column:
    """Whether a row's fingerprint can be one of those in the bitmap."""
    shared = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def hit(prints: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(prints.to_numpy(), shared.value))

    return hit(F.col("print"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """``(row, text, keep_id, group_size, kept)``: the input row as a struct, its normalised text and group."""
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id"), normalised(text_or_empty()).alias("text"))
    printed = rows.withColumn("print", F.xxhash64("text"))
    repeated = staged(repeated_prints(printed.select("print")), "repeated")
    hit = may_repeat(spark, bitmap_of(repeated))
    alone = printed.filter(~hit).select(
        "row", "text", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"))
    routed = staged(printed.filter(hit).select("row", F.monotonically_increasing_id().alias("at")), "routed") \
        .withColumn("text", normalised(F.coalesce("row.text", F.lit("")))) \
        .withColumn("print", F.xxhash64("text"))
    first = F.min(F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id").alias("id"), "at"))
    groups = staged(routed.groupBy("print", "text").agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
    verified = routed.join(groups, ["print", "text"]).select(
        "row", "text", F.col("first.id").alias("keep_id"), "group_size",
        (F.col("at") == F.col("first.at")).alias("kept"))
    return alone.unionByName(verified)


def exact_digests(docs: DataFrame) -> DataFrame:
    """One row per document with the id that stays for it, and the digest of its normalised text."""
    return exact_groups(docs.select("doc_id", "text")).select(
        "row.doc_id", "keep_id", "group_size", "kept", F.sha2("text", 256).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents without their exact copies, columns as they were."""
    return exact_groups(docs).filter("kept").select("row.*")
