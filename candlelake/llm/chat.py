"""Chat formatting with multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once with that speaker as the
assistant and all others as named users; the mask covers what the assistant says, closing mark
included. Speakers listed in ``NARRATORS`` give context in every rendering and take no turn as the
assistant. A long conversation comes in parts of ``PART_TURNS`` turn numbers, so that no task holds a
whole one; parts in order join to the whole dialogue.

Rows with the same conversation, turn, role and text are one turn. Turns are ordered by number, null
last, then by role and text. A null role is the speaker ``unknown``; a null text is empty; a null
conversation id is one conversation. The opening mark inside a text is broken up, so a text cannot
pose as a turn. A conversation of narrators only has no perspectives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SHUT, END = "<|", "|>", "<|end|>\n"
NARRATORS = ("system",)
PART_TURNS = 64


def _harmless(text: Column) -> Column:
    return F.replace(text, F.lit(OPEN), F.lit("< |"))


def perspectives(turns: DataFrame, narrators: tuple[str, ...] = NARRATORS, part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, speaker, part, n_turns, n_masked, dialogue, mask``; mask as ``start:end`` in code points."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).distinct() \
        .withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)))
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn").isNull().alias("undated"), "turn", "role", "text"))).alias("turns"))
    speakers = rows.filter(~F.col("role").isin(*narrators)).select(F.col("conv_id").alias("of"), "role").distinct() \
        .withColumnRenamed("role", "speaker")
    both = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")

    def head(turn: Column) -> Column:
        role = turn["role"]
        said = F.when(role == F.col("speaker"), F.lit("assistant")) \
            .when(role.isin(*narrators), _harmless(role)).otherwise(F.concat(F.lit("user "), _harmless(role)))
        return F.concat(F.lit(OPEN), said, F.lit(SHUT + "\n"))

    segment = F.transform("turns", lambda turn: F.struct(
        head(turn).alias("head"), F.concat(_harmless(turn["text"]), F.lit(END)).alias("body"),
        (turn["role"] == F.col("speaker")).alias("own")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(done: Column, turn: Column) -> Column:
        low = done["at"] + F.length(turn["head"])
        high = low + F.length(turn["body"])
        span = F.array(F.concat(low.cast("string"), F.lit(":"), high.cast("string")))
        return F.struct(high.alias("at"), F.when(turn["own"], F.concat(done["spans"], span))
                        .otherwise(done["spans"]).alias("spans"))

    rendered = both.withColumn("segments", segment).withColumn("spans", F.aggregate("segments", start, step)["spans"])
    return rendered.select(
        "conv_id", "speaker", "part", F.size("segments").cast("long").alias("n_turns"),
        F.size("spans").cast("long").alias("n_masked"),
        F.array_join(F.transform("segments", lambda x: F.concat(x["head"], x["body"])), "").alias("dialogue"),
        F.array_join("spans", ",").alias("mask"))
