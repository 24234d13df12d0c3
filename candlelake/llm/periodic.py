"""Periodic runs of words, found with a suffix automaton and link-cut access.

A run is a stretch of consecutive words with a smallest period ``q`` (words ``q`` apart are identical) that
no neighbouring word extends. The suffix links of the automaton form a tree whose nodes stand for the
substrings; a link-cut tree keeps, on its preferred paths, the place where each node last ended. Appending
word ``i`` accesses the node of the prefix that ends there: the path to the root is recoloured with ``i``, one
segment of equal colour after the other, ``O(log n)`` of them amortised. A segment of colour ``p`` whose longest
substring has ``L`` words says that the ``L`` words up to ``i`` last ended at ``p``; if ``i - p <= L`` the distance
is a period and a square ends at ``i``. Nothing longer ends at both places, so the run starts at
``p - L + 1``; it ends at the last ``i`` that reports the same start and period.

Before that a text is cut at places no run can cross: with at least four periods and six words, every three
consecutive words of a run occur three times in the text. The automaton is built for each stretch that is
left; what it needs is in proportion to the stretch.

A null text counts as empty, an empty one has no runs. Rows come back as often as they come in, whatever
columns they have; ties between runs are settled by start, then period. Whole texts are searched, whatever
their length. Words are compared as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from candlelake.llm.common import SPACE, slices, utf8

LEAST_WORDS, LEAST_PERIODS = 6, 4
RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
ARROW_RUN = pa.struct([(field.name, pa.int64()) for field in RUN.fields])


def suffix_automaton(word: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and longest length of every state, and the state of every prefix.

    State 1 is the empty word; 0 stands for none.
    """
    step: list[dict[int, int]] = [{}, {}]
    link, longest, prefix = [0, 0], [0, 0], []
    last = 1
    for letter in word:
        new = len(link)
        step.append({})
        longest.append(longest[last] + 1)
        link.append(1)
        state = last
        while state and letter not in step[state]:
            step[state][letter] = new
            state = link[state]
        if state:
            follow = step[state][letter]
            if longest[follow] == longest[state] + 1:
                link[new] = follow
            else:
                copy = len(link)
                step.append(step[follow].copy())
                longest.append(longest[state] + 1)
                link.append(link[follow])
                link[follow] = link[new] = copy
                while state and step[state].get(letter) == follow:
                    step[state][letter] = copy
                    state = link[state]
        prefix.append(new)
        last = new
    return link, longest, prefix


class LastEnds:
    """Where each state's words last ended, as colours of the preferred paths of a link-cut tree.

    A path is a splay tree ordered by depth; all of a path has one colour, kept at its root.
    """

    def __init__(self, link: list[int], longest: list[int]):
        self.longest = longest
        self.up = link[:]
        self.left, self.right = [0] * len(link), [0] * len(link)
        self.colour = [-1] * len(link)

    def _rotate(self, node: int) -> None:
        up, left, right = self.up, self.left, self.right
        parent = up[node]
        above = up[parent]
        if left[parent] == node:
            inner = left[parent] = right[node]
            right[node] = parent
        else:
            inner = right[parent] = left[node]
            left[node] = parent
        if inner:
            up[inner] = parent
        up[parent], up[node] = node, above
        if left[above] == parent:
            left[above] = node
        elif right[above] == parent:
            right[above] = node

    def _splay(self, node: int) -> None:
        """Makes the node the root of its path's tree and hands it the path's colour."""
        up, left, right = self.up, self.left, self.right
        root = node
        while True:
            parent = up[node]
            if not parent or left[parent] != node and right[parent] != node:
                break
            above = up[parent]
            if above and (left[above] == parent or right[above] == parent):
                root = above
                self._rotate(parent if (left[parent] == node) == (left[above] == parent) else node)
            else:
                root = parent
            self._rotate(node)
        self.colour[node] = self.colour[root]

    def access(self, state: int, place: int) -> Iterator[tuple[int, int]]:
        """Recolours the path from a state to the root; yields ``(longest length, last place)`` of its segments."""
        up, right, colour = self.up, self.right, self.colour
        below = 0
        while state:
            self._splay(state)
            seen = colour[state]
            if seen >= 0:
                yield self.longest[state], seen
            cut = right[state]
            if cut:
                colour[cut] = seen
            right[state] = below
            below, state = state, up[state]
        colour[below] = place


def runs_of(word: Sequence[int], least_words: int = LEAST_WORDS,
            least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs with so many words and periods (two at least), by start and period."""
    link, longest, prefix = suffix_automaton(word)
    last_ends = LastEnds(link, longest)
    ends: dict[tuple[int, int], int] = {}
    for place, state in enumerate(prefix):
        for length, seen in last_ends.access(state, place):
            if place - seen <= length:
                ends[seen - length + 1, place - seen] = place
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items()
                  if end - start + 1 >= max(least_words, least_periods * period))


def stretches(ids: np.ndarray, owner: np.ndarray, least_words: int, least_periods: int) -> list[tuple[int, int]]:
    """Bounds of the parts of texts that can hold a run; ``owner`` numbers the text of each word.

    In a run of ``k`` periods every three consecutive words occur ``k - 1`` times at least, or as often as the
    shortest run of one word has room for them. Where that is less than twice, whole texts are searched.
    """
    often = min(least_periods - 1, least_words - 2)
    if often < 2:
        cuts = np.flatnonzero(np.diff(owner)) + 1
        return list(zip([0, *cuts], [*cuts, len(ids)], strict=True))
    if len(ids) < least_words:
        return []
    word = ids.astype(np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    mixed = ((owner[2:].astype(np.uint64) * factor + word[:-2]) * factor + word[1:-1]) * factor + word[2:]
    codes, _ = pd.factorize(mixed)
    frequent = (np.bincount(codes)[codes] >= often) & (owner[2:] == owner[:-2])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], frequent.astype(np.int8), [0]])))
    found = []
    for low, high in zip(edges[::2].tolist(), (edges[1::2] + 2).tolist(), strict=True):
        # neighbouring texts cannot share a stretch: the groups of words across their border are not frequent
        if high - low >= least_words:
            found.append((low, high))
    return found


def collapse_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """``(row, runs, collapsed)``: the input row, its runs, and its words without the repetitions of any run.

    ``row`` keeps every column of ``docs``, whatever the names; only ``text`` is read. ``collapsed`` joins the
    kept words by one space: a word goes if some run holds it after the run's first period.
    """
    if least_periods < 2:
        raise ValueError("a run has two periods at least")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        split = [text.split() for text in utf8(batch.column("text"))]
        words = [word for part in split for word in part]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        first = np.concatenate([[0], np.cumsum(sizes)])
        codes = np.empty(0, np.int64)
        if words:
            held = np.empty(len(words), object)
            held[:] = words
            codes, _ = pd.factorize(held)
        owner = np.repeat(np.arange(len(split)), sizes)
        kept = np.ones(len(words), bool)
        runs: list[list[dict]] = [[] for _ in split]
        for low, high in stretches(codes, owner, least_words, least_periods):
            text = int(owner[low])
            for start, length, period in runs_of(codes[low:high].tolist(), least_words, least_periods):
                runs[text].append({"start": low + start - int(first[text]), "length": length, "period": period})
                kept[low + start + period:low + start + length] = False
        texts = []
        for part, low in zip(split, first, strict=False):
            stays = kept[low:low + len(part)]
            texts.append(b" ".join(part if stays.all() else [part[i] for i in np.flatnonzero(stays)]))
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(runs, pa.list_(ARROW_RUN)), pa.array(texts, pa.binary()).view(pa.string())],
            ["row", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield work(batch)

    rows = docs.select(F.struct("*").alias("row"), "text")
    return rows.mapInArrow(run, StructType([
        rows.schema["row"], StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())]))


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period, then the smallest start, then the smallest period."""
    def order(a: Column, b: Column) -> Column:
        more = b["length"] * a["period"] - a["length"] * b["period"]
        return F.when(more != 0, F.signum(more)).otherwise(
            F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
            .otherwise(F.signum(a["period"] - b["period"]))).cast("int")
    return F.get(F.array_sort(runs, order), F.lit(0))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where a tenth of the texts repeat some of their words from a place on to the end.

    ``h`` is the CRC-32 of the decimal id, ``g`` a tenth of it; texts with ``h % 10 = 0`` repeat
    ``1 + (n - a) / (3 + g % 8)`` words from word ``a = g % n`` on. A row without id is left alone.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    split = F.filter(F.split(F.coalesce("text", F.lit("")), SPACE), lambda word: word != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, split).alias("words"))
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    period = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(
        F.slice("words", a + 1, period), F.ceil((n - a) / period).cast("int"))), F.lit(1), n - a)
    damaged = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return rows.select("doc_id", F.when(n > 0, damaged).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """Per document of ``docs`` (with periodic tails) its runs, the strongest of them, and digests."""
    found = collapse_runs(with_periodic_tails(docs)).select("row.doc_id", "runs", "collapsed")
    line = F.transform("runs", lambda run: F.concat(
        F.array_join(F.array(*(run[field.name].cast("string") for field in RUN.fields)), ","), F.lit("\n")))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
