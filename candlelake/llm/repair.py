"""Repair of conversation structure by depth-first branch and bound.

A conversation is repaired to an optional system turn and then pairs of user and assistant turns, or to
nothing. Keeping a row costs 0, giving it the role user or assistant 1, deleting it 2 (blank and duplicate
rows must go), inserting an empty user or assistant turn 5; a truncated row that stays adds 5. Of the
cheapest edits the ASCII-least sequence of initials (``D``, ``I``, ``K``, ``R``) is taken.

``repair`` searches with an explicit stack. A node is a place between rows and the role that came last;
bounds on what the rest must cost come from a relaxation in which a system row may stay anywhere while no
turn stands yet. The best (cost, edits) that reached a node is kept with it and anything worse is dropped:
edits that reach a node at the same cost differ before either ends, since every edit has its own cost, so
the lesser one stays the lesser whatever follows. The search ends when the stack is empty: nothing left
could beat the incumbent.

Rows arrive sorted by range partitions of conversation and turn, so one shuffle moves the texts and a hot
conversation is spread over many tasks. A task repairs the conversations that lie inside its partition and
have at most ``SEGMENT_ROWS`` rows. The others (the first and last of a partition, and long ones) are passed
on in segments: for each segment the cheapest edits between any two roles are searched, the segments of a
conversation are joined by their few numbers and edits, and the texts meet the chosen edits in place.

Identical rows of one turn are counted, not repeated; rows of one turn are ordered by role, then text. Rows
without conversation id are one conversation, rows without turn come first. A null role or text is one
space; a row with an empty role cannot stay under it. Conversations of which nothing is left have zeros, no edits and an empty repair. Column names are
chosen by this module; extra columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, count, groupby, repeat
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from candlelake.llm.common import staged

BLANKS = " \t\n\v\f\r"
ENDS = (".", "!", "?")
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
NONE, SYSTEM, USER, ASSISTANT = "", "s", "u", "a"
STATES = (NONE, SYSTEM, USER, ASSISTANT)
FINAL = (NONE, ASSISTANT)
LEGAL = {SYSTEM + USER, USER + ASSISTANT, ASSISTANT + USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
SEGMENT_ROWS = 2048
SEGMENT_BYTES = 4 << 20
NEVER = 1 << 60
OUT_OF_REACH = 3 * COST[INSERT]


@dataclass(frozen=True, slots=True)
class Turn:
    """A row as the search sees it; what must go stands for ``times`` rows in a line."""

    initial: str
    must_go: bool = False
    truncated: bool = False
    times: int = 1


def follow(last: str) -> str:
    """The only one of user and assistant that can come after a role."""
    return ASSISTANT if last == USER else USER


def moves(turn: Turn, last: str) -> Iterator[tuple[int, str, str]]:
    """``(cost, edits, role that then came last)`` of everything that can be done with a row.

    Giving a row the role that it could keep is left out: it costs one more for the same result.
    """
    yield COST[DELETE] * turn.times, DELETE * turn.times, last
    if turn.must_go:
        return
    more = TRUNCATED_COST * turn.truncated
    if turn.initial == SYSTEM and last == NONE:
        yield COST[KEEP] + more, KEEP, SYSTEM
    if turn.initial == follow(last):
        yield COST[KEEP] + more, KEEP, turn.initial
    else:
        yield COST[REROLE] + more, REROLE, follow(last)


def suffix_bounds(turns: list[Turn], final: tuple[str, ...]) -> list[dict[str, int]]:
    """A lower bound of the cost from every place and last role to one of the final roles.

    Relaxed: before the first user turn, any number of system rows may stay.
    """
    now = {last: 0 if last in final else NEVER for last in STATES}
    now[NONE] = min(now[NONE], now[SYSTEM])
    bounds = []
    for turn in (None, *reversed(turns)):
        if turn:
            now = {last: min(cost + now[then] for cost, _, then in moves(turn, last))
                   for last in (NONE, USER, ASSISTANT)}
        user, assistant = now[USER], now[ASSISTANT]
        now[USER], now[ASSISTANT] = min(user, COST[INSERT] + assistant), min(assistant, COST[INSERT] + user)
        now[NONE] = now[SYSTEM] = min(now[NONE], COST[INSERT] + now[USER])
        bounds.append(now)
    return bounds[::-1]


def repair(turns: list[Turn], start: str = NONE, final: tuple[str, ...] = FINAL) -> tuple[int, str] | None:
    """The least (cost, edits) that leads from the role before the rows to a final one; None if nothing does."""
    bounds = suffix_bounds(turns, final)
    best: tuple[int, str] | None = None
    reached: list[dict[str, tuple[int, str]]] = [{} for _ in range(len(turns) + 1)]
    stack = [(0, "", 0, start)]
    while stack:
        cost, edits, place, last = stack.pop()
        bound = cost + bounds[place][last]
        if bound >= NEVER or best and (bound, edits) > (best[0], best[1][:len(edits)]):
            continue
        known = reached[place].get(last)
        if known and known <= (cost, edits):
            continue
        reached[place][last] = cost, edits
        if place == len(turns) and last in final and (not best or (cost, edits) < best):
            best = cost, edits
        ways = [(cost + COST[INSERT], edits + INSERT, place, follow(last))]
        if place < len(turns):
            ways += [(cost + more, edits + edit, place + 1, then) for more, edit, then in moves(turns[place], last)]
        # the most promising way is taken first, of equal ones the lesser edits
        ways.sort(key=lambda way: (way[0] + bounds[way[2]][way[3]], way[1]), reverse=True)
        stack.extend(ways)
    return best


@dataclass(slots=True)
class Facts:
    """What can be counted of consecutive rows, and how they look to the search."""

    turns: list[Turn] = field(default_factory=list)
    numbers: set[int] = field(default_factory=set)
    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str = NONE
    last: str = NONE


def facts_of(rows: list[dict], repeated: set[int] | None = None) -> Facts:
    """Faults of rows ``{turn, role, text, copies}`` in order.

    ``repeated`` names the places whose role and text stand earlier; without it that is looked up here.
    """
    facts, seen = Facts(), set()
    for place, row in enumerate(rows):
        copies, role, text = row["copies"], row["role"], row["text"]
        if not copies:
            continue
        if row["turn"] is not None:
            facts.numbers.add(row["turn"])
        initial, body = role[:1], text.rstrip(BLANKS)
        facts.illegal += copies - 1 + (facts.rows > 0 and facts.last + initial not in LEGAL)
        facts.first = facts.first if facts.rows else initial
        facts.last = initial
        facts.rows += copies
        if repeated is None:
            again = (role, text) in seen
            seen.add((role, text))
        else:
            again = place in repeated
        if not body:
            facts.blank += copies
            facts.turns.append(Turn(initial, must_go=True, times=copies))
            continue
        first = not again
        if first:
            cut = body[-1] not in ENDS
            facts.truncated += cut
            facts.turns.append(Turn(initial, truncated=cut))
        if copies > first:
            facts.duplicate += copies - first
            facts.turns.append(Turn(initial, must_go=True, times=copies - first))
    return facts


def edited(rows: list[dict], edits: str, last: str = NONE) -> list[dict]:
    """The rows after the edits, as ``{role, text}``; ``last`` is the role before them."""
    left = chain.from_iterable(repeat(row, row["copies"]) for row in rows)
    result = []
    for edit in edits:
        if edit == INSERT:
            turn = {"role": ROLE[follow(last)], "text": ""}
        else:
            row = next(left)
            if edit == DELETE:
                continue
            turn = {"role": row["role"] if edit == KEEP else ROLE[follow(last)], "text": row["text"]}
        last = turn["role"][:1]
        result.append(turn)
    return result


def whole(rows: list[dict]) -> tuple[dict, list[dict]]:
    """Report and repaired turns of a conversation at hand."""
    facts = facts_of(rows)
    cost, edits = repair(facts.turns)
    gaps = max(facts.numbers) - min(facts.numbers) + 1 - len(facts.numbers) if facts.numbers else 0
    return {"gaps": gaps, "blank": facts.blank, "duplicate": facts.duplicate, "truncated": facts.truncated,
            "illegal": facts.illegal, "cost": cost, "audit": edits}, edited(rows, edits)


# -- types ----------------------------------------------------------------------------------

ROW = StructType([StructField("turn", LongType()), StructField("role", StringType()),
                  StructField("text", StringType()), StructField("copies", LongType())])
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPORT = StructType([*(StructField(name, LongType()) for name in COUNTS), StructField("audit", StringType())])
REPAIRED = ArrayType(StructType([StructField("role", StringType()), StructField("text", StringType())]))
WAY = StructType([StructField("start", StringType()), StructField("final", StringType()),
                  StructField("cost", LongType()), StructField("edits", StringType())])
NUMBERS = ("low", "high", "numbers", "rows", "blank", "duplicate", "truncated", "illegal")


def record_batch(records: list[dict], schema: StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(records, to_arrow_schema(schema))


# -- sorted rows to conversations and segments ----------------------------------------------

def arranged(turns: DataFrame, copies: Column) -> DataFrame:
    """Rows counted and sorted by conversation and turn over range partitions; no text is too common to deal."""
    def or_space(name: str) -> Column:
        return F.coalesce(name, F.lit(" ")).alias(name)

    rows = turns.select("conv_id", "turn", or_space("role"), or_space("text"), copies.cast("long").alias("copies")) \
        .groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    return rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)) \
        .sortWithinPartitions("conv_id", "turn", "role", "text")


def split_conversations(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Of sorted rows, one record per conversation inside a partition, or per segment of any other.

    ``segment`` is null for a finished conversation, which comes with report and repaired turns; else it orders
    the segments of a conversation, which come with their rows.
    """
    schema = StructType([
        rows.schema["conv_id"], StructField("segment", LongType()), StructField("turns", ArrayType(ROW)),
        StructField("report", REPORT), StructField("repaired", REPAIRED)])

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        number = count(TaskContext.get().partitionId() << 40)
        stream = (row for batch in batches for row in batch.to_pylist())
        first, held = True, None
        for conv_id, group in groupby(stream, itemgetter("conv_id")):
            if held:
                yield finished(*held)
                held = None
            open_end, part, size = first, [], 0
            for row in group:
                row.pop("conv_id")
                if len(part) >= segment_rows or part and size + len(row["text"]) > SEGMENT_BYTES:
                    yield {"conv_id": conv_id, "segment": next(number), "turns": part}
                    open_end, part, size = True, [], 0
                part.append(row)
                size += len(row["text"])
            if open_end:
                yield {"conv_id": conv_id, "segment": next(number), "turns": part}
            else:
                held = conv_id, part
            first = False
        if held:
            yield {"conv_id": held[0], "segment": next(number), "turns": held[1]}

    def finished(conv_id: object, part: list[dict]) -> dict:
        report, repaired = whole(part)
        return {"conv_id": conv_id, "report": report, "repaired": repaired}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for record in records(batches):
            held.append(record)
            size += 200 + sum(len(turn["text"]) + 40 for turn in record.get("turns") or record["repaired"])
            if size > SEGMENT_BYTES:
                yield record_batch(held, schema)
                held, size = [], 0
        if held:
            yield record_batch(held, schema)

    return rows.mapInArrow(run, schema)


# -- conversations in segments --------------------------------------------------------------

def repeated_places(segments: DataFrame) -> DataFrame:
    """``segment, repeated``: places whose role and text stand earlier in the same conversation."""
    rows = segments.select("conv_id", "segment", F.posexplode("turns").alias("place", "row")) \
        .filter("row.copies > 0") \
        .select("conv_id", F.struct("segment", "place").alias("at"), "row.role", "row.text")
    firsts = rows.groupBy("conv_id", "role", "text").agg(F.min("at").alias("first"), F.count("at").alias("n")) \
        .filter("n > 1").drop("n").alias("f")
    same = F.col("f.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("f.role") == F.col("r.role")) \
        & (F.col("f.text") == F.col("r.text"))
    return rows.alias("r").join(firsts, same).filter("at > first") \
        .groupBy("at.segment").agg(F.collect_list("at.place").alias("repeated"))


def searched_segments(segments: DataFrame) -> DataFrame:
    """Per segment its counts, its outer roles, and the cheapest edits between any two roles."""
    schema = StructType([
        segments.schema["conv_id"], StructField("segment", LongType()),
        *(StructField(name, LongType()) for name in NUMBERS),
        StructField("first", StringType()), StructField("last", StringType()), StructField("ways", ArrayType(WAY))])

    def search(record: dict) -> dict:
        facts = facts_of(record["turns"], set(record["repeated"] or ()))
        ways = []
        for start in STATES:
            for final in STATES:
                found = repair(facts.turns, start, (final,))
                if found:
                    ways.append({"start": start, "final": final, "cost": found[0], "edits": found[1]})
        return {"conv_id": record["conv_id"], "segment": record["segment"], "ways": ways,
                "low": min(facts.numbers, default=None), "high": max(facts.numbers, default=None),
                "numbers": len(facts.numbers),
                **{name: getattr(facts, name) for name in (*NUMBERS[3:], "first", "last")}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                yield record_batch([search(batch.slice(place, 1).to_pylist()[0])], schema)

    places = repeated_places(segments)
    return segments.select("conv_id", "segment", "turns").join(places, "segment", "left") \
        .select("conv_id", "segment", "turns", "repeated").mapInArrow(run, schema)


def cheapest_chain(ways_by_segment: list[list[dict]]) -> list[dict]:
    """The way taken through every segment so that all edits together are the cheapest, then the least.

    A role that costs more than ``OUT_OF_REACH`` above another cannot win any more: two insertions lead from any
    role to the assistant, whose rest costs at most one insertion more than that of any other role. What all
    remaining roles share is settled and not compared again.
    """
    settled: list[dict] = []
    best: dict[str, tuple[int, str, list[dict]]] = {NONE: (0, "", [])}
    for ways in ways_by_segment:
        reached: dict[str, tuple[int, str, list[dict]]] = {}
        for way in ways:
            if way["start"] not in best:
                continue
            cost, edits, taken = best[way["start"]]
            new = cost + way["cost"], edits + way["edits"]
            if way["final"] not in reached or new < reached[way["final"]][:2]:
                reached[way["final"]] = *new, [*taken, way]
        least = min(cost for cost, *_ in reached.values())
        best = {last: found for last, found in reached.items() if found[0] <= least + OUT_OF_REACH}
        while all(taken for *_, taken in best.values()) and len({id(taken[0]) for *_, taken in best.values()}) == 1:
            shared = next(iter(best.values()))[2][0]
            settled.append(shared)
            best = {last: (cost, edits[len(shared["edits"]):], taken[1:])
                    for last, (cost, edits, taken) in best.items()}
    return settled + min(best[last] for last in FINAL if last in best)[2]


def chosen_edits(searched: DataFrame) -> DataFrame:
    """Per segment the role before it and its edits; the first one brings the report of the conversation.

    One conversation's numbers and edits, a few bytes a row, meet in a task: its edits are one value of the result.
    """
    schema = StructType([
        searched.schema["conv_id"], StructField("segment", LongType()), StructField("start", StringType()),
        StructField("edits", StringType()), StructField("report", REPORT)])

    def choose(found: pa.Table) -> pa.Table:
        parts = sorted(found.to_pylist(), key=itemgetter("segment"))
        taken = cheapest_chain([part["ways"] for part in parts])
        numbers = illegal = 0
        last = low = high = None
        for part in parts:
            if part["low"] is not None:
                # rows come by turn, so neighbouring segments can share one number
                numbers += part["numbers"] - (part["low"] == high)
                low, high = part["low"] if low is None else low, part["high"]
            if part["rows"]:
                illegal += part["illegal"] + (last is not None and last + part["first"] not in LEGAL)
                last = part["last"]
        report = {"gaps": high - low + 1 - numbers if low is not None else 0, "illegal": illegal,
                  **{name: sum(part[name] for part in parts) for name in ("blank", "duplicate", "truncated")},
                  "cost": sum(way["cost"] for way in taken), "audit": "".join(way["edits"] for way in taken)}
        rows = [{"conv_id": part["conv_id"], "segment": part["segment"], "start": way["start"], "edits": way["edits"],
                 "report": None if place else report} for place, (part, way) in enumerate(zip(parts, taken, strict=True))]
        return pa.Table.from_batches([record_batch(rows, schema)])

    return searched.groupBy("conv_id").applyInArrow(choose, schema)


def rendered_segments(segments: DataFrame, chosen: DataFrame) -> DataFrame:
    """``conv_id, segment, repaired``: the repaired turns of every segment."""
    schema = StructType([segments.schema["conv_id"], StructField("segment", LongType()),
                         StructField("repaired", REPAIRED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                record = batch.slice(place, 1).to_pylist()[0]
                turns = edited(record["turns"], record["edits"], record["start"])
                yield record_batch([{"conv_id": record["conv_id"], "segment": record["segment"],
                                     "repaired": turns}], schema)

    return segments.select("conv_id", "segment", "turns").join(
        chosen.select("segment", "start", "edits"), "segment") \
        .select("conv_id", "segment", "turns", "start", "edits").mapInArrow(run, schema)


def repaired_text(repaired: str = "repaired") -> Column:
    """The turns as lines ``role:text``."""
    return F.array_join(F.transform(repaired, lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"])), "\n")


def streamed_digests(rendered: DataFrame) -> DataFrame:
    """``of, repaired_sha256`` of conversations in segments: the digest runs over them in order."""
    schema = StructType([StructField("of", rendered.schema["conv_id"].dataType),
                         StructField("repaired_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for row in batch.to_pylist())
        for conv_id, parts in groupby(stream, itemgetter("conv_id")):
            digest, some = hashlib.sha256(), False
            for part in parts:
                if part["turns"]:
                    digest.update((("\n" if some else "") + part["lines"]).encode())
                    some = True
            yield record_batch([{"of": conv_id, "repaired_sha256": digest.hexdigest()}], schema)

    return rendered.select("conv_id", "segment", F.size("repaired").alias("turns"), repaired_text().alias("lines")) \
        .repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(run, schema)


# -- the operator and its query -------------------------------------------------------------

def repair_steps(turns: DataFrame, copies: Column, segment_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Finished conversations, the chosen edits of segments, and the repaired segments."""
    split = staged(split_conversations(arranged(turns, copies), segment_rows), "repair-split")
    segments = split.filter("segment IS NOT NULL")
    chosen = staged(chosen_edits(staged(searched_segments(segments), "repair-searched")), "repair-chosen")
    return split.filter("segment IS NULL"), chosen, rendered_segments(segments, chosen)


def repair_conversations(turns: DataFrame, segment_rows: int = SEGMENT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Two tables: ``conv_id`` with counts, ``cost`` and ``audit``, and ``conv_id, part, repaired``.

    ``repaired`` is an array of role and text; the parts of a conversation follow each other by number, and the
    part is null if there is only one.
    """
    inside, chosen, rendered = repair_steps(turns, F.lit(1), segment_rows)
    reports = inside.unionByName(chosen.filter("report IS NOT NULL"), allowMissingColumns=True)
    repaired = inside.unionByName(rendered, allowMissingColumns=True)
    return (reports.select("conv_id", "report.*"),
            repaired.select("conv_id", F.col("segment").alias("part"), "repaired"))


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with faults by the CRC-32 of conversation and turn, and how often each then stands.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 gives it to the user.
    Nulls count as one space.
    """
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select(
        "conv_id", "turn", fate.alias("fate"),
        F.when(fate == 4, F.lit("user")).otherwise(text("role")).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text"))
        .alias("text"))
    return rows, F.when(F.col("fate") == 0, F.lit(0)).when(F.col("fate") == 3, F.lit(2)).otherwise(F.lit(1))


def repair_report(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Per conversation the report of its repair after damage, and the digest of the repaired turns.

    Only conversations in segments need a join; the others have report and turns in one row.
    """
    inside, chosen, rendered = repair_steps(*damaged(conversations), segment_rows)
    digests = streamed_digests(rendered)
    segmented = chosen.filter("report IS NOT NULL").join(digests, F.col("conv_id").eqNullSafe(F.col("of")))
    return inside.select("conv_id", "report.*", F.sha2(repaired_text(), 256).alias("repaired_sha256")).unionByName(
        segmented.select("conv_id", "report.*", "repaired_sha256"))
