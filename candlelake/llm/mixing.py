"""Mixing sources to target weights by exponential keys and prefix sums.

A source's target is its share of the budget by weight, no more than ``MOST_EPOCHS`` times its size;
what a source cannot take is shared again by weight among the others. A target is met with complete
epochs first. For the fraction that is left, every document gets the key ``-ln(u) / quality``
(Efraimidis and Spirakis: the smaller the key, the earlier a weighted draw without replacement picks
it), and documents are taken in key order as long as half of their words still fit, which ends as
near to the target as whole documents allow.

No source is sorted as a whole. The keys of a source with ``n`` documents fall into about ``sqrt(n)``
ranges, whose sums are added up in order; only the range in which the target falls is sorted. What is
left is one cut per source, a table as long as the list of sources.

A null text has size 0. A null source is a source of its own, the last in order. Repeated rows with
the same id and text share one key and one decision. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.common import small, staged, text_or_empty, word_count

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 2
SEED = "mix"


def quality(text: Column) -> Column:
    """Squared share of letters and white space, 0.05 at least."""
    kept = F.length(F.regexp_replace(text, r"[^\p{L}\x20\x09-\x0D]", ""))
    share = kept.cast("double") / F.greatest(F.length(text), F.lit(1)).cast("double")
    return F.greatest(share * share, F.lit(0.05).cast("double"))


def draw_key(seed: str = SEED) -> Column:
    """Exponential key of a document: a digest of id and text as the uniform draw."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                     text_or_empty())
    draw = (F.conv(F.substring(F.md5(named), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(draw) / quality(text_or_empty())


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    return docs.select("doc_id", "source", word_count(text_or_empty()).alias("size"), draw_key(seed).alias("key"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2)) -> DataFrame:
    """Adds ``target`` to ``source, source_size``: one row per source, so one task suffices.

    In order of size by weight the sources at their limit come first. With their limits taken off
    the budget, the rest divides what remains by weight.
    """
    up, down = share
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(ordered) - 1) % len(weights) + 1)
    by_need = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_need.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    planned = (
        sources.withColumn("weight", weight).withColumn("limit", MOST_EPOCHS * F.col("source_size"))
        .withColumn("budget", F.lit(up) * F.sum("source_size").over(every))
        .withColumn("left", F.col("budget") - down * F.coalesce(F.sum("limit").over(earlier), F.lit(0)))
        .withColumn("heavy", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        .withColumn("full", F.col("limit").cast("decimal(38,0)") * F.col("heavy") * down
                    <= F.col("left").cast("decimal(38,0)") * F.col("weight"))
        .withColumn("level", F.col("left").cast("double") / (down * F.col("heavy")).cast("double"))
        .withColumn("place", F.row_number().over(by_need))
    )
    level = F.min(F.when(~F.col("full"), F.struct("place", "level"))).over(every)["level"]
    met = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(level * F.col("weight"))
    return planned.withColumn("target", met).select(*sources.columns, "weight", "target")


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _range() -> Column:
    """Which of a source's key ranges a key falls in; rising with the key."""
    return F.least(F.floor((1 - F.exp(-F.col("key"))) * F.col("ranges")), F.col("ranges") - 1)


def plan(rows: DataFrame) -> DataFrame:
    """One row per source: size, target, complete epochs, and the last document of the fraction.

    ``rows`` is a stored table of ``doc_id, source, size, key``.
    """
    counted = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = staged(targets(staged(counted, "sources")), "targets").select(
        F.col("source").alias("of"), "source_size", "target",
        F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).alias("epochs"),
        F.ceil(F.sqrt("n")).alias("ranges")) \
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    ranged = rows.join(small(sources), _same("source", "of")).withColumn("range", _range())
    sums = ranged.groupBy("of", "range").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
    up_to = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = sums.withColumn("before", F.coalesce(F.sum("words").over(up_to), F.lit(0))) \
        .filter("before <= rest").groupBy("of") \
        .agg(F.max_by(F.struct("range", "before"), "range").alias("end")) \
        .select(F.col("of").alias("source"), F.col("end.range").alias("last"), "end.before")
    ends = staged(ends, "ends")
    edge = rows.join(small(sources), _same("source", "of")).withColumn("range", _range()).drop("source") \
        .join(small(ends), F.col("of").eqNullSafe(F.col("source")) & (F.col("range") == F.col("last")))
    order = F.struct("key", "doc_id", "size")
    sorted_ = Window.partitionBy("of").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    done = F.col("before") + F.coalesce(F.sum("size").over(sorted_), F.lit(0))
    cuts = edge.withColumn("done", done).filter("2 * done + size <= 2 * rest") \
        .groupBy("of").agg(F.max(order).alias("cut"))
    return sources.join(ends, _same("of", "source"), "left").drop("source") \
        .join(cuts.withColumnRenamed("of", "source"), _same("of", "source"), "left").drop("source")


def copies() -> Column:
    """How often the mix takes a document joined with its source's plan."""
    order = F.struct("key", "doc_id", "size")
    inside = (_range() < F.col("last")) | ((_range() == F.col("last")) & (order <= F.col("cut")))
    return F.col("epochs") + F.coalesce(inside, F.lit(False)).cast("long")


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words the mix takes."""
    rows = staged(sized(docs), "sized")
    return rows.join(small(staged(plan(rows), "plan")), _same("source", "of")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies()).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix, a document of a second epoch twice; columns as they were."""
    cuts = small(staged(plan(staged(sized(docs), "sized")), "plan"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", word_count(text_or_empty()).alias("size"),
                       draw_key().alias("key"))
    return rows.join(cuts, _same("source", "of")).withColumn("copies", copies()).filter("copies > 0") \
        .select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
