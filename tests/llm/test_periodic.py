"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import ODD
from pyspark.sql import functions as F

from candlelake.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(word, least_words=6, least_periods=4):
    """Runs from the definition: every stretch that keeps a period, the smallest one of that stretch."""
    found = {}
    codes = {}
    word = np.array([codes.setdefault(w, len(codes)) for w in word], np.int64)
    for period in range(1, len(word) // least_periods + 1):
        same = np.flatnonzero(np.diff(np.concatenate([[0], (word[:-period] == word[period:]).view(np.int8), [0]])))
        for low, high in zip(same[::2].tolist(), same[1::2].tolist(), strict=True):
            if high - low + period >= max(least_words, least_periods * period):
                found.setdefault((low, high - low + period), period)
    # a multiple of a run's period keeps the same stretch
    return sorted((start, length, period) for (start, length), period in found.items())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def report(doc_id, text):
    """The contract's row of one document, by definition."""
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join("{},{},{}\n".format(*r) for r in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def rows_of(df):
    return sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in df.collect()), key=repr)


def test_report_equals_brute_force(documents, texts):
    got = rows_of(periodic.run_report(documents))
    assert got == sorted(((i, *report(i, t)) for i, t in texts.items()), key=repr)
    assert sum(r[1] for r in got) > 5


def test_odd_rows(make):
    """Nulls, empty and blank texts, repeated rows, one long period, and ids whose texts get a periodic tail."""
    damaged = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [*ODD, (400, "a b " * 400 + "c a b c a b c a b c a b c x x x x x x y"), (401, "q q q q q"),
            *((i, "") for i in damaged[:2]), *((i, "one two three four five six seven " * 3) for i in damaged[2:])]
    assert rows_of(periodic.run_report(make(rows))) == sorted(((i, *report(i, t)) for i, t in rows), key=repr)


def test_no_rows(make):
    empty = periodic.run_report(make([(1, "a")]).filter("doc_id = 0"))
    assert empty.collect() == [] and set(COLUMNS) < set(empty.columns)


def test_rows_keep_their_columns(make):
    docs = make([(1, "x  a b a b\ta b a b a b z", "news"), (2, None)])
    one, two = sorted(periodic.collapse_runs(docs).collect(), key=lambda r: r.row.doc_id)
    assert one.collapsed == "x a b z" and [tuple(r) for r in one.runs] == [(1, 10, 2)]
    assert (one.row.source, one.row.kept, one.row.text) == ("news", 7, "x  a b a b\ta b a b a b z")
    assert (two.collapsed, two.runs) == ("", [])


def test_strongest_run(spark):
    runs = [(5, 9, 2), (1, 18, 4), (9, 8, 2), (30, 27, 6)]
    df = spark.createDataFrame([([dict(zip(("start", "length", "period"), r)) for r in runs],), ([],)],
                               "runs array<struct<start:long,length:long,period:long>>")
    assert [r[0] and tuple(r[0]) for r in df.select(periodic.strongest(F.col("runs"))).collect()] == [(1, 18, 4), None]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=5), st.integers(1, 9)), max_size=6),
       st.sampled_from([(6, 4), (2, 2), (3, 3), (9, 5)]))
def test_runs_of_any_words(parts, least):
    word = [letter for part, times in parts for letter in part * times]
    assert periodic.runs_of(word, *least) == brute(word, *least)
    ids, owner = np.array(word, np.int64), np.zeros(len(word), np.int64)
    cut = [(low + start, length, period) for low, high in periodic.stretches(ids, owner, *least)
           for start, length, period in periodic.runs_of(word[low:high], *least)] if word else []
    assert sorted(cut) == brute(word, *least)


def test_long_words_stay_fast():
    """A path of colours per access, not every state of it: a text of one word has 50,000 states in a row."""
    assert periodic.runs_of([0] * 50_000) == [(0, 50_000, 1)]
    thue = [bin(i).count("1") % 2 for i in range(20_000)]
    assert periodic.runs_of(thue) == []
    assert all(length < 3 * period for _, length, period in periodic.runs_of(thue, 2, 2))
