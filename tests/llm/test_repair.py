"""Conversation repair against the definition."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from candlelake.llm import repair
from candlelake.llm.repair import Turn

FORMAT = re.compile(r"(s?(ua)+)?")
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
CONVERSATIONS = StructType([
    StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()),
    StructField("text", StringType()), *(StructField(n, IntegerType()) for n in ("segment", "copies", "part", "fate"))])


def every_repair(rows):
    """All edits of rows ``(role, text, fault)`` that cost no more than deleting everything: (cost, audit, turns)."""
    def extend(place, cost, audit, turns, inserted):
        if cost > 2 * len(rows):
            return
        if place == len(rows) and FORMAT.fullmatch("".join(role[:1] for role, _ in turns)):
            yield cost, audit, turns
        if inserted < 2:
            for role in ("user", "assistant"):
                yield from extend(place, cost + 5, audit + "I", [*turns, (role, "")], inserted + 1)
        if place < len(rows):
            role, text, fault = rows[place]
            yield from extend(place + 1, cost + 2, audit + "D", turns, 0)
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role:
                    yield from extend(place + 1, cost + more, audit + "K", [*turns, (role, text)], 0)
                for other in ("user", "assistant"):
                    yield from extend(place + 1, cost + 1 + more, audit + "R", [*turns, (other, text)], 0)
    return extend(0, 0, "", [], 0)


def best_repair(rows):
    """The same by tables: the least (cost, audit, turns) of every place and last role."""
    inf = (10 ** 9, "", ())

    def inserted(table):
        for _ in range(3):
            for last in ("", "s", "u", "a"):
                cost, audit, turns = table.get(last, inf)
                role = "assistant" if last == "u" else "user"
                new = cost + 5, audit + "I", (*turns, (role, ""))
                table[role[0]] = min(table.get(role[0], inf), new)
        return table

    table = inserted({"": (0, "", ())})
    for role, text, fault in rows:
        after = {}

        def put(last, *new):
            after[last] = min(after.get(last, inf), new)
        for last, (cost, audit, turns) in table.items():
            put(last, cost + 2, audit + "D", turns)
            if fault in ("blank", "duplicate"):
                continue
            more = 5 * (fault == "truncated")
            for pay, edit, name in ((0, "K", role), (1, "R", "user"), (1, "R", "assistant")):
                if name and last + name[0] in ("s", "u", "su", "ua", "au"):
                    put(name[0], cost + pay + more, audit + edit, (*turns, (name, text)))
        table = inserted(after)
    return min(table.get("", inf), table.get("a", inf))


def faults(rows):
    seen, result = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen \
            else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        result.append((role, text, fault))
    return result


def expected(conversations, damage=True):
    """Contract rows of ``(conv_id, turn, role, text)``."""
    kept = defaultdict(list)
    for conv_id, turn, role, text in conversations:
        rows = kept[conv_id]
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        fate = zlib.crc32(key.encode()) % 20 if damage else 9
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        rows += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    result = []
    for conv_id, rows in kept.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        numbers = {turn for turn, *_ in rows if turn is not None}
        marked = faults([row[1:] for row in rows])
        count = [sum(f == kind for *_, f in marked) for kind in ("blank", "duplicate", "truncated")]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, turns = best_repair(marked)
        lines = "\n".join(f"{role}:{text}" for role, text in turns)
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        result.append((conv_id, gaps, *count, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest()))
    return sorted(result, key=repr)


def rows_of(df):
    return sorted(((r.conv_id, *(r[c] for c in COLUMNS)) for r in df.collect()), key=repr)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 7, 7, 7, 7) for r in rows], CONVERSATIONS).repartition(parts)


LINES = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]),
                           st.sampled_from(["a.", "b!", "c", "", " \n", "d? \t"])), max_size=5)


@settings(max_examples=400, deadline=None)
@given(LINES)
def test_tables_agree_with_all_edits(rows):
    marked = faults(rows)
    least = min(every_repair(marked), key=lambda found: found[:2])
    assert (least[0], least[1], tuple(least[2])) == best_repair(marked)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool"]),
                          st.sampled_from(["a.", "b!", "c", "", "d", "e.", "f."])), max_size=30), st.integers(1, 9))
def test_search_and_segments(rows, size):
    marked = faults(rows)
    turns = [Turn(role[:1], fault in ("blank", "duplicate"), fault == "truncated") for role, _, fault in marked]
    want = best_repair(marked)
    assert repair.repair(turns) == want[:2]
    plain = [{"role": role, "text": text, "copies": 1} for role, text in rows]
    assert [(t["role"], t["text"]) for t in repair.edited(plain, want[1])] == list(want[2])
    parts = []
    for low in range(0, len(turns), size):
        ways = []
        for start in repair.STATES:
            for final in repair.STATES:
                found = repair.repair(turns[low:low + size], start, (final,))
                if found:
                    ways.append({"start": start, "final": final, "cost": found[0], "edits": found[1]})
        parts.append(ways)
    taken = repair.cheapest_chain(parts)
    assert (sum(way["cost"] for way in taken), "".join(way["edits"] for way in taken)) == want[:2]


def test_bounds_never_exceed_the_cost():
    draw = random.Random(3)
    for _ in range(300):
        turns = [Turn(draw.choice("usat"), draw.random() < .2, draw.random() < .2) for _ in range(draw.randint(0, 12))]
        bounds = repair.suffix_bounds(turns, repair.FINAL)
        for place in range(len(turns) + 1):
            for last in repair.STATES:
                found = repair.repair(turns[place:], last)
                assert bounds[place][last] <= found[0]


def test_long_conversations_end():
    for letters in ("s", "u", "ua", "uua", "sua", "t", "uas"):
        turns = [Turn(letters[i % len(letters)], i % 7 == 3, i % 5 == 1) for i in range(1500)]
        cost, edits = repair.repair(turns)
        assert len(edits) - edits.count("I") == 1500 and cost <= 3000


def test_query_equals_brute_force(spark, folder):
    df = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    want = expected(rows)
    assert rows_of(repair.repair_report(df)) == want
    assert rows_of(repair.repair_report(df, segment_rows=2)) == want
    assert len({audit for *_, audit, _ in want}) > 5


def odd(seed, n=400):
    draw = random.Random(seed)
    rows = [(draw.choice([None, 1, 2, 3, 4, 5, 5, 5, 5]), draw.choice([None, *range(-3, 40)]),
             draw.choice([None, "user", "assistant", "system", "", "tool"]),
             draw.choice([None, "", " \t", "yes.", "no", "long " * 200 + "!", "日本。", "a.\0", f"{draw.random()}?"]))
            for _ in range(n)]
    # identical rows many times, one conversation that damage drops whole, one without any turn number
    gone = next(i for i in range(100, 400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return [*rows, *[(7, 3, "user", "again.")] * 500, (gone, 0, "user", "x."), *[(8, None, "user", "x.")] * 2]


@pytest.mark.parametrize("segment_rows", [3, 2048])
def test_odd_rows(spark, segment_rows):
    """Nulls everywhere, blank texts, ties, repeated rows, hot conversations, clashing columns."""
    rows = odd(segment_rows)
    assert rows_of(repair.repair_report(table(spark, rows), segment_rows)) == expected(rows)


def test_no_rows(spark):
    assert rows_of(repair.repair_report(table(spark, []))) == []


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi!"), (1, 2, "user", "Well?"), (1, 3, "assistant", "Yes."),
            (2, 0, "assistant", " ")]
    reports, parts = repair.repair_conversations(table(spark, rows), segment_rows=2)
    found = {r.conv_id: r for r in reports.collect()}
    want = {row[0]: row for row in expected(rows, damage=False)}
    assert {i: (i, *(found[i][c] for c in COLUMNS[:-1])) for i in found} == {i: row[:-1] for i, row in want.items()}
    turns = defaultdict(list)
    for part in sorted(parts.collect(), key=lambda r: r.part or 0):
        turns[part.conv_id] += [(t.role, t.text) for t in part.repaired]
    assert turns[1] == [("system", "Be brief."), ("user", "Well?"), ("assistant", "Yes.")] and turns[2] == []
    assert found[1].audit == "KDKK"
