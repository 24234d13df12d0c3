"""Substring deduplication by prefix-partitioned suffix trees over words.

A suffix is followed for ``DEPTH`` words. Its prefix runs as far as the first rare group of words that
the whole window agrees on: of the ``SYNC``-word groups in the window the one with the smallest hash,
groups in overfull hash ranges coming last. Such prefixes have any length; equal windows have equal
ones, and neighbouring suffixes that run to the same group stay together and travel as one segment of
words. The hash of that last group deals the segments to partitions sized for memory.

A partition builds the levels of its subtree for depths 1, 2, 4, 8, 16 and 20: a node of the next level
is a pair of nodes of this one, and branches with a single suffix are cut at once. Nodes at full depth
with more than one suffix are the deep internal nodes; all their suffixes but the earliest are repeats,
and runs of them are the maximal repeats. Words are compared as words, not by hash.

Each task first builds the subtree of its own block of documents and keeps back what repeats inside the
block. A passage that a third of the documents share reaches its partition once per block. Segments
whose last group occurs only once in the corpus cannot repeat; the groups that occur more often are
marked in a bitmap of bounded size, and only segments that hit it travel.

Earlier means a smaller ``doc_id`` (null last), in one document an earlier place. Rows with the same id
and different texts are ordered by a digest of 127 bits of the text; repeated rows are one document, whose words are
not repeats of themselves. A null text has no words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import shuffle_parts, slices, staged, utf8
from candlelake.llm.exact import bitmap_of, in_bitmap, repeated_prints

DEPTH, SYNC = 20, 4
BLOCK_BYTES, SMALL_BLOCK = 4 << 20, 2 << 20
RANGES, FULL, FULL_AT_LEAST = 1 << 16, 16, 2048
RANGE_PIECE = 4096
GROUPS_PER_PARTITION = 4
FACTOR = np.uint64(0x9E3779B97F4A7C15)
NO_ID = 2**63 - 1
HEADER = np.dtype([("doc", "<u4"), ("place", "<u4"), ("sync", "<u4"), ("windows", "u1")])
RUN = np.dtype([("doc", "<u4"), ("place", "<u4"), ("windows", "<u4")])


def deep_nodes(codes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Node at full depth of the suffix at each word, -1 where it has no other suffix.

    ``room`` is the number of words up to the end of the text a word is in.
    """
    def level(node: np.ndarray, other: np.ndarray, step: int, depth: int) -> np.ndarray:
        out = np.full(codes.size, -1, np.int64)
        at = np.flatnonzero((room >= depth) & (node >= 0))
        at = at[other[at + step] >= 0]
        if not at.size:
            return out
        pair = node[at] * (other.max() + 1) + other[at + step]
        name, _ = pd.factorize(pair)
        many = np.bincount(name)[name] > 1
        out[at[many]] = name[many]
        return out

    count = np.bincount(codes, minlength=1)
    node = np.where(count[codes] > 1, codes, -1)
    for half in (1, 2, 4, 8):
        node = level(node, node, half, 2 * half)
    return level(node, node, DEPTH - 16, DEPTH)


def rooms(lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.repeat(ends, lengths) - np.arange(ends[-1] if ends.size else 0)


def sync_hashes(codes: np.ndarray, names: list[bytes]) -> np.ndarray:
    """Hash of the ``SYNC`` words from each word on."""
    digest = xxhash.xxh64_intdigest
    word = np.array([digest(name) for name in names], np.uint64)[codes]
    out = word.copy()
    for i in range(1, SYNC):
        out[:-i] = out[:-i] * FACTOR + word[i:]
    return (out ^ (out >> np.uint64(31))) * FACTOR


def first_sync(rank: np.ndarray) -> np.ndarray:
    """Place of the leftmost smallest rank among the groups of the window at each word."""
    groups = DEPTH - SYNC + 1
    value, place = rank, np.arange(rank.size)

    def lower(a: tuple, b: tuple) -> tuple:
        right = b[0] < a[0]
        return np.where(right, b[0], a[0]), np.where(right, b[1], a[1])

    span = 1
    while 2 * span <= groups:
        value, place = lower((value[:-span], place[:-span]), (value[span:], place[span:]))
        span *= 2
    shift = groups - span
    if shift:
        value, place = lower((value[:-shift], place[:-shift]), (value[shift:], place[shift:]))
    return place


class Block:
    """Words of a block of documents, in order of id; repeated rows once."""

    def __init__(self, batch: pa.RecordBatch):
        ids = pc.fill_null(batch.column("doc_id").cast(pa.int64()), NO_ID).to_numpy()
        bodies = batch.column("body").to_numpy()
        others = batch.column("other").to_numpy()
        order = by_row(ids, bodies, others)
        same = [np.diff(column[order]) == 0 for column in (ids, bodies, others)]
        order = order[np.concatenate([[True], ~np.logical_and.reduce(same)])] if order.size else order
        texts = utf8(batch.column("text"))
        self.ids, self.bodies, self.others = ids[order], bodies[order], others[order]
        split = [texts[i].split() for i in order]
        self.words = [word for part in split for word in part]
        self.lengths = np.array([len(part) for part in split], np.int64)
        self.codes, names = pd.factorize(np.array(self.words, object)) if self.words else (np.empty(0, np.int64), [])
        self.names = list(names)
        self.room = rooms(self.lengths)
        self.doc = np.repeat(np.arange(order.size), self.lengths)
        self.place = np.arange(len(self.words)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)


def _blocks(docs: DataFrame) -> DataFrame:
    """Rows with 127 bits of their text and, in the last bit of ``other``, whether they lack an id."""
    none = F.col("doc_id").isNull().cast("long")
    return docs.select("doc_id", F.xxhash64("text").alias("body"),
                       F.shiftleft(F.xxhash64(F.lit(1), "text"), 1).bitwiseOR(none).alias("other"), "text")


def by_row(ids: np.ndarray, bodies: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Order of rows: by id, those without one last, then by digest."""
    return np.lexsort((others, bodies, others & 1, ids))


def overfull(docs: DataFrame) -> np.ndarray:
    """Hash ranges of word groups that hold far more than their share, over the whole corpus."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RANGES, np.int64)
        for batch in slices(batches, limit=SMALL_BLOCK):
            split = [text.split() for text in utf8(batch.column("text"))]
            words = [word for part in split for word in part]
            if not words:
                continue
            codes, names = pd.factorize(np.array(words, object))
            hashes = sync_hashes(codes, list(names))[rooms(np.array([len(part) for part in split])) >= SYNC]
            total += np.bincount((hashes >> np.uint64(48)).astype(np.int64), minlength=RANGES)
        pieces = total.reshape(-1, RANGE_PIECE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(pieces)), pa.int32()), pa.array([x.tobytes() for x in pieces], pa.binary())],
            ["piece", "counts"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.int64) for x in frame["counts"]], axis=0)
        return pd.DataFrame({"piece": frame["piece"][:1], "counts": [total.astype(np.int64).tobytes()]})

    kind = "piece int, counts binary"
    total = np.zeros((RANGES // RANGE_PIECE, RANGE_PIECE), np.int64)
    for piece, counts in docs.select("text").mapInArrow(count, kind).groupBy("piece").applyInPandas(add, kind).collect():
        total[piece] = np.frombuffer(bytes(counts), np.int64)
    return total.ravel() > max(FULL_AT_LEAST, FULL * total.mean())


def _runs(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Windows as runs of neighbouring ones."""
    if not doc.size:
        return np.empty(0, RUN)
    first = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(place) != 1)]))
    out = np.empty(first.size, RUN)
    out["doc"], out["place"] = doc[first], place[first]
    out["windows"] = np.diff(np.concatenate([first, [doc.size]]))
    return out


def repeats_of(node: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which suffixes (in order of document and place) are not the earliest of their node."""
    at = np.flatnonzero(node >= 0)
    order = at[np.argsort(node[at], kind="stable")]
    new = np.concatenate([[True], np.diff(node[order]) != 0]) if order.size else np.empty(0, bool)
    first = order[np.maximum.accumulate(np.where(new, np.arange(order.size), 0))]
    out = np.zeros(node.size, bool)
    out[order] = (doc[first] != doc[order]) | (place[first] != place[order])
    return out


def window_syncs(block: Block, full: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where the prefix of the window at each word ends; only meaningful where a window fits."""
    rank = (hashes >> np.uint64(1)) | (full[(hashes >> np.uint64(48)).astype(np.int64)].astype(np.uint64) << np.uint64(63))
    return first_sync(rank)


def repeated_syncs(docs: DataFrame, full: np.ndarray) -> DataFrame:
    """``print``: hashes of the prefix ends that occur more than once."""
    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in slices(batches, limit=SMALL_BLOCK):
            block = Block(batch)
            start = np.flatnonzero(block.room >= DEPTH)
            if start.size:
                hashes = sync_hashes(block.codes, block.names)
                places = np.unique(window_syncs(block, full, hashes)[start])
                yield hashes[places]

    return repeated_prints(_blocks(docs), ends)


def _segments(block: Block, full: np.ndarray, shared: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """By partition the block's segments, and the runs of windows that repeat inside the block."""
    compress = zstandard.ZstdCompressor(level=3).compress
    repeat = repeats_of(deep_nodes(block.codes, block.room), block.doc, block.place)
    start = np.flatnonzero((block.room >= DEPTH) & ~repeat)
    hashes = sync_hashes(block.codes, block.names)
    sync = window_syncs(block, full, hashes)[start] if start.size else start
    met = in_bitmap(hashes[sync], shared)
    start, sync = start[met], sync[met]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(sync) != 0) | (np.diff(start) != 1)])) if start.size else start
    size = np.diff(np.concatenate([first, [start.size]])) if start.size else start
    low, sync = start[first], sync[first]
    line = b" ".join(block.words)
    ends = np.cumsum([len(word) + 1 for word in block.words]) - 1 if block.words else np.empty(0, np.int64)
    begins = np.concatenate([[0], ends[:-1] + 1]) if block.words else ends
    head = np.empty(low.size, HEADER)
    head["doc"], head["place"], head["windows"] = block.doc[low], block.place[low], size
    head["sync"] = hashes[sync] & np.uint64(0xFFFFFFFF)
    part = (hashes[sync] % np.uint64(parts)).astype(np.int64)
    texts = list(zip(begins[low].tolist(), ends[low + size + DEPTH - 2].tolist(), strict=True))
    order = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) != 0, [True]])) if order.size else [0]

    at = np.flatnonzero(repeat)
    runs = _runs(block.doc[at], block.place[at])
    run_part = block.bodies[runs["doc"]].astype(np.int64) % parts
    for i in np.unique(run_part):
        mine = runs[run_part == i]
        docs, inside = np.unique(mine["doc"], return_inverse=True)
        mine["doc"] = inside
        yield int(i), b"", compress(_packed(block, docs, mine.tobytes()))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        mine = order[a:b]
        docs, inside = np.unique(head["doc"][mine], return_inverse=True)
        own = head[mine]
        own["doc"] = inside
        body = b"\n".join([line[x:y] for x, y in (texts[i] for i in mine.tolist())])
        yield int(part[mine[0]]), compress(_packed(block, docs, own.tobytes(), body)), b""


def _packed(block: Block, docs: np.ndarray, records: bytes, text: bytes = b"") -> bytes:
    counts = np.array([docs.size, len(records)], np.int64)
    return b"".join([counts.tobytes(), *(column[docs].astype(np.int64).tobytes() for column in (
        block.ids, block.bodies, block.others)), records, text])


def _unpacked(data: bytes, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Id and digest of the documents (three columns), records, and text."""
    data = zstandard.ZstdDecompressor().decompress(data)
    docs, size = (int(x) for x in np.frombuffer(data, np.int64, 2))
    keys = np.frombuffer(data, np.int64, 3 * docs, 16).reshape(3, docs).T
    at = 16 + 24 * docs
    return keys, np.frombuffer(data, kind, size // kind.itemsize, at), data[at + size:]


def _by_document(keys: np.ndarray, runs: np.ndarray) -> pd.DataFrame:
    """A row per document with its runs as bytes; ``doc`` of the runs is a row of keys."""
    first = np.flatnonzero(np.concatenate([[True], np.diff(runs["doc"].astype(np.int64)) != 0])) if runs.size else []
    doc = runs["doc"][first] if runs.size else np.empty(0, np.int64)
    pairs = np.stack([runs["place"], runs["windows"]], axis=1).astype("<u4") if runs.size else np.empty((0, 2), "<u4")
    cuts = [*first, runs.size]
    return pd.DataFrame({
        "id": np.where(keys[doc, 2] & 1, 0, keys[doc, 0]), "hash": keys[doc, 1], "rest": keys[doc, 2],
        "runs": [pairs[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]})


def _subtree(frame: pd.DataFrame) -> pd.DataFrame:
    """The repeats among a partition's segments, and the block repeats it was handed."""
    out = []
    for data in frame["runs"]:
        if data:
            keys, runs, _ = _unpacked(data, RUN)
            out.append(_by_document(keys, runs))
    blocks = [_unpacked(data, HEADER) for data in frame["segments"] if data]
    if blocks:
        names, counts = np.unique(np.concatenate([x[1]["sync"] for x in blocks]), return_counts=True)
        shared = names[counts > 1]
        heads, texts, key = [], [], []
        for keys, head, text in blocks:
            keep = np.flatnonzero(np.isin(head["sync"], shared))
            lines = text.split(b"\n")
            texts += [lines[i] for i in keep.tolist()]
            own = head[keep]
            heads.append(own)
            key.append(keys[own["doc"]])
        head, key = np.concatenate(heads), np.concatenate(key)
        order = np.argsort(head["place"], kind="stable")
        order = order[by_row(*key[order].T)]
        head, key = head[order], key[order]
        lengths = head["windows"].astype(np.int64) + DEPTH - 1
        words = b" ".join([texts[i] for i in order.tolist()]).split(b" ") if texts else []
        if words:
            codes, _ = pd.factorize(np.array(words, object))
            number = np.cumsum(np.concatenate([[False], (np.diff(key, axis=0) != 0).any(axis=1)]))
            doc = np.repeat(number, lengths)
            place = np.repeat(head["place"].astype(np.int64) - (np.cumsum(lengths) - lengths), lengths) + np.arange(doc.size)
            repeat = np.flatnonzero(repeats_of(deep_nodes(codes, rooms(lengths)), doc, place))
            _, first = np.unique(number, return_index=True)
            out.append(_by_document(key[first], _runs(doc[repeat], place[repeat])))
    kinds = {"id": np.int64, "hash": np.int64, "rest": np.int64, "runs": object}
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({k: pd.Series([], dtype=v) for k, v in kinds.items()})


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``id, hash, rest, runs``: runs of repeated windows (place and number, as bytes) by document and partition."""
    spark = docs.sparkSession
    full = overfull(docs)
    shared = spark.sparkContext.broadcast(bitmap_of(staged(repeated_syncs(docs, full), "syncs")))
    parts = GROUPS_PER_PARTITION * shuffle_parts(spark)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=BLOCK_BYTES):
            rows = list(_segments(Block(batch), full, shared.value, parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary()),
                 pa.array([x[2] for x in rows], pa.binary())], ["part", "segments", "runs"])

    return _blocks(docs).mapInArrow(deal, "part int, segments binary, runs binary") \
        .groupBy("part").applyInPandas(_subtree, "id long, hash long, rest long, runs binary")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words outside repeated windows, joined by one space."""
    runs = repeated_windows(docs).groupBy("id", "hash", "rest").agg(F.collect_list("runs").alias("runs"))
    rows = _blocks(docs).join(
        runs, (F.coalesce("doc_id", F.lit(0)) == F.col("id")) & (F.col("body") == F.col("hash"))
        & (F.col("other") == F.col("rest")), "left").select("doc_id", "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, removed, kept = [], [], []
            for text, parts in zip(utf8(batch.column("text")), batch.column("runs").to_pylist(), strict=True):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int64)
                for place, windows in np.frombuffer(b"".join(parts or []), "<u4").reshape(-1, 2).astype(np.int64):
                    edge[place] += 1
                    edge[place + windows + DEPTH - 1] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                sizes.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone)] if removed[-1] else words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept string")


def repeat_report(docs: DataFrame) -> DataFrame:
    """One row per document with its number of words, of removed words, and a digest of the rest."""
    return without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
