"""Document fingerprints by spot signatures, in DataFrame expressions only.

An anchor is a common word; a spot signature is an anchor with the chain of the next content words
(words that are no anchors). Running text has many, navigation and lists few. The set of hashed
signatures is the fingerprint. Two given sets are compared by their Jaccard likeness. For a similarity join
it is pruned by length: sets whose lengths differ too much cannot reach the threshold and are not intersected; sets
are partitioned by length so that only neighbouring partitions can hold similar sets, and meet in one
of the rarest signatures of either.

A null text counts as empty. A text with few signatures also has its words as such, and one without
words itself, so that equal texts have equal fingerprints and different short texts different ones. The next document is the
one with the next smaller ``doc_id`` (null last, repeated ids by text), after the last the first.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.common import small, staged, text_or_empty

ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "that", "the",
    "this", "to", "was", "with",
    "auf", "das", "den", "der", "die", "ein", "eine", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    "dans", "de", "des", "du", "est", "et", "la", "le", "les", "que", "qui", "sur", "un", "une",
    "con", "del", "el", "en", "las", "los", "para", "por", "se", "su", "y")
CHAIN, REACH, FEW = 2, 8, 4
MOST_RANGES = 1 << 14


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda word: word != "")


def signatures(words: str, text: str, chain: int = CHAIN, reach: int = REACH,
               anchors: tuple[str, ...] = ANCHORS) -> Column:
    """Sorted 32-bit hashes of the different spot signatures of a column of words."""
    def spot(word: Column, place: Column) -> Column:
        content = F.slice(F.filter(F.slice(words, place + 2, F.lit(reach)), lambda x: ~x.isin(*anchors)), 1, chain)
        return F.when(word.isin(*anchors), F.when(F.size(content) == chain, F.hash(word, content)))

    spots = F.array_distinct(F.array_compact(F.transform(words, spot)))
    alone = F.when(F.size(words) > 0, F.transform(words, lambda word: F.hash(word))).otherwise(F.array(F.hash(text)))
    return F.sort_array(F.when(F.size(spots) >= FEW, spots).otherwise(F.array_union(spots, alone)))


def spotted(rows: DataFrame) -> DataFrame:
    """The rows with ``spots``, the signatures of their texts."""
    return rows.withColumn("words", words(F.col("text"))).withColumn("spots", signatures("words", "text")).drop("words")


def written(spots: str) -> Column:
    """A fingerprint as text: number of signatures, and each of them in hex."""
    hexes = F.transform(spots, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit((1 << 32) - 1))), 8, "0"))
    return F.concat(F.size(spots).cast("string"), F.lit(":"), F.lower(F.array_join(hexes, "")))


def jaccard(left: str, right: str) -> Column:
    """Likeness of two sets."""
    both = F.size(F.array_intersect(left, right))
    return both / (F.size(left) + F.size(right) - both)


def pruned_jaccard(left: str, right: str, threshold: float) -> Column:
    """Likeness of two sets, 0 if their lengths alone keep it below the threshold; such sets are not intersected."""
    a, b = F.size(left), F.size(right)
    return F.when(F.least(a, b) < threshold * F.greatest(a, b), F.lit(0.0)).otherwise(jaccard(left, right))


def id_bounds(rows: DataFrame) -> list[int]:
    """Lower bounds of ranges of ``doc_id`` that hold about as many rows each, whatever the ids.

    There are about as many ranges as a range has rows, ``MOST_RANGES`` at most.
    """
    ranges = min(MOST_RANGES, max(1, math.isqrt(rows.count())))
    shares = [k / ranges for k in range(1, ranges)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 4 * ranges)).first()[0] if shares else None
    return sorted(set(found or []))


def range_of(bounds: list[int], doc_id: str = "doc_id") -> Column:
    """How many of the bounds are not above the id, by halving; -1 for a null."""
    sorted_bounds = F.lit(np.array(bounds, np.int64))

    def halve(low: Column, step: Column) -> Column:
        above = low + step
        return F.when((above <= len(bounds)) & (F.get(sorted_bounds, above - 1) <= F.col(doc_id)), above).otherwise(low)

    steps = F.lit(np.array([1 << k for k in reversed(range(len(bounds).bit_length()))], np.int32))
    place = F.aggregate(steps, F.lit(0), halve) if bounds else F.lit(0)
    return F.when(F.col(doc_id).isNull(), F.lit(-1)).otherwise(place)


def with_next(rows: DataFrame, add: Callable[[DataFrame], DataFrame], *columns: str) -> DataFrame:
    """The rows with what ``add`` computes, and ``next``: the named columns (text first) of the next document in
    descending order of id.

    Ids fall into ranges of about as many rows. Each range is ordered by itself, with the
    first row of the range below put after its last, so the texts are exchanged once, and ``add`` runs once a row.
    """
    rows = rows.withColumn("range", range_of(id_bounds(rows)))
    heads = staged(rows.groupBy("range").agg(F.max("doc_id").alias("head")), "heads")
    above = Window.orderBy(F.desc("range"))
    owners = heads.withColumn("owner", F.coalesce(F.lag("range").over(above), F.min("range").over(Window.partitionBy())))
    owners = staged(owners.withColumnRenamed("range", "of"), "owners")
    first = rows.join(small(owners), (F.col("range") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("head"))) \
        .groupBy("owner").agg(F.min("text").alias("text")) \
        .select(F.col("owner").alias("range"), "text", F.lit(True).alias("added"))
    both = add(rows.withColumn("added", F.lit(False)).unionByName(first, allowMissingColumns=True))
    order = Window.partitionBy("range").orderBy("added", F.col("doc_id").desc_nulls_last(), "text")
    return both.withColumn("next", F.lead(F.struct(*columns)).over(order)).filter(~F.col("added")).drop("added", "range")


def edited_report(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and both likenesses."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    both = with_next(rows, spotted, "text", "spots").withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - cut), F.substring("next.text", F.lit(1), cut))
    both = both.select("doc_id", "n_chars", "spots", edited.alias("edited"), F.col("next.spots").alias("next_spots"))
    done = both.withColumn("words", words(F.col("edited"))).withColumn("edited_spots", signatures("words", "edited"))
    return done.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written("spots").alias("fingerprint"),
        written("edited_spots").alias("edited_fingerprint"),
        jaccard("spots", "edited_spots").alias("near_edited"), jaccard("spots", "next_spots").alias("near_next"))


def fingerprint_classes(docs: DataFrame) -> DataFrame:
    """Stored table of ``doc_id, spots, class_id``: documents with the same set share a class, its smallest id."""
    rows = docs.select("doc_id", words(text_or_empty()).alias("words"), text_or_empty().alias("text"))
    rows = staged(rows.select("doc_id", signatures("words", "text").alias("spots")), "spots")
    classes = rows.groupBy("spots").agg(F.min("doc_id").alias("class_id"))
    return staged(rows.join(classes, "spots"), "classes")


def similar_classes(classes: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``a, b, likeness``: all pairs of classes whose sets are at least so similar.

    Sets are ordered by how rare their signatures are; similar sets share one of the first
    ``n - ceil(threshold * n) + 1``. Lengths fall into partitions whose bounds grow by 1/threshold, so a
    set meets its own partition and the next.
    """
    sets = staged(classes.filter("class_id is not null").select("class_id", "spots").distinct(), "sets")
    seen = sets.select("class_id", F.explode("spots").alias("spot"))
    counts = seen.groupBy("spot").agg(F.count("*").alias("n"))
    ranked = seen.join(counts, "spot").groupBy("class_id").agg(F.sort_array(F.collect_list(F.struct("n", "spot"))).alias("r"))
    size = F.size("r")
    keys = ranked.select(
        "class_id", size.alias("size"), F.floor(F.log(size) / math.log(1 / threshold) + 1e-9).alias("level"),
        F.explode(F.slice("r.spot", F.lit(1), size - F.ceil(size * threshold - 1e-9).cast("int") + 1)).alias("spot"))
    left = keys.select(F.col("class_id").alias("a"), F.col("size").alias("size_a"), "spot", "level")
    right = keys.select(F.col("class_id").alias("b"), F.col("size").alias("size_b"), "spot",
                        F.explode(F.array(F.col("level"), F.col("level") - 1)).alias("level"))
    fits = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b")))
    met = left.join(right, ["spot", "level"]).filter(fits & (F.col("size_a") >= threshold * F.col("size_b"))) \
        .select("a", "b").distinct()
    one = sets.select(F.col("class_id").alias("a"), F.col("spots").alias("left"))
    two = sets.select(F.col("class_id").alias("b"), F.col("spots").alias("right"))
    return met.join(one, "a").join(two, "b").withColumn("likeness", pruned_jaccard("left", "right", threshold)) \
        .filter(F.col("likeness") >= threshold).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")
