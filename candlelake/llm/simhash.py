"""SimHash near-deduplication by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 4 of 64 bits share a variant that differs from either in at
most 2. Every fingerprint therefore stands for its 2,081 variants (none, one or two bits flipped),
variants are dealt to buckets, and fingerprints that meet in a variant are linked.

The bits fall into ``g`` groups; the bucket of a variant is made of the parities of its groups. So the
variants of one fingerprint lie in only ``1 + g + g*(g-1)/2`` buckets, the same flips for each of them:
the fingerprint travels once to each of these buckets, and the bucket emits the variants that belong to
it. ``g`` follows the number of different fingerprints, so a bucket's work does not grow with the data,
and parities spread even a dense cluster, which plain prefixes would not.

All fingerprints of one variant are within the radius of each other, so linking them to the smallest
one loses no link, and a bucket returns a spanning forest of its links (verified by distance) instead
of all pairs. Equal fingerprints collapse before any of this.

One fingerprint of 64 bits and a radius of 4 links texts that differ in little. To find all texts with a
Jaccard likeness of 0.8 over five-word shingles, :func:`similar_groups` first gives a text several independent
fingerprints over shorter shingles, takes pairs that meet in one of them as candidates, and verifies them by
their five-word shingles. That connects dense clusters cheaply but misses pairs. An exact search follows: in
an order common to all texts, two similar texts share one of their first ``n - ceil(0.8 n) + 1`` shingles.
Texts that share such a shingle and could still be similar by size and place are verified, unless they are
connected already: in written rounds the first few texts of a shingle are held against all others, then
eight times as many, until every text of it was. The order puts shingles that a sample of the texts repeats
last; it decides how many pairs are verified, never which are found.

Texts are lower-cased (A-Z) and cut into shingles of words between ASCII white space, repeats
included; fewer words make one shingle; a text without words (or null) has the fingerprint zero. A
null ``doc_id`` is no candidate for the smallest id of its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import SLICE_BYTES, passing, per_slice, shuffle_parts, small, staged, utf8
from candlelake.llm.components import components

SEED, SHINGLE, RADIUS = 42, 4, 4
#: Similar texts: five-word shingles, likeness, and the fingerprints that find candidates for it.
WORDS, LIKENESS, TABLES, CANDIDATE_WORDS = 5, 0.8, 2, 2
HALF_CHUNK = 1 << 17
ODD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
VARIANTS_PER_BUCKET = 1 << 21
#: Order of shingles: hash bits of a counted slot, and one text in so many is counted.
SLOT_BITS, COUNTED = 24, 8
#: Texts of a shingle held against all others in the first round, and how many times more in the next.
FIRST_HUBS, MORE_HUBS = 4, 8
#: Slots of shingle counts, a byte each: at least and at most so many, as powers of two between, and the count that
#: stands for that many or more.
FEWEST_SLOTS, MOST_SLOTS, FULL_SLOT = 1 << 6, 1 << 14, 255


def fingerprint(text: bytes, width: int = SHINGLE, tables: int = 1) -> np.ndarray:
    """Fingerprints of a text; those after the first take their bits from hashes of the shingle hashes."""
    words = text.lower().split()
    if not words:
        return np.zeros(tables, np.uint64)
    hashes = shingle_hashes(words, width)
    out = np.empty(tables, np.uint64)
    for table in range(tables):
        if table:
            mixed = hashes * np.uint64((2 * table + 1) * int(ODD) % (1 << 64))
            mixed = (mixed ^ (mixed >> np.uint64(32))) * MIX
            bits_of = mixed ^ (mixed >> np.uint64(32))
        else:
            bits_of = hashes
        ones = np.zeros(64, np.int64)
        for low in range(0, hashes.size, HALF_CHUNK):
            part = bits_of[low:low + HALF_CHUNK].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        out[table] = np.packbits(2 * ones > hashes.size, bitorder="little").view("<u8")[0]
    return out


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Hash of every shingle in order; a shorter text is one shingle."""
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in
                     zip(starts[:last].tolist(), ends[-last:].tolist(), strict=True)], "<u8")


def words_digest(text: bytes) -> tuple[int, int]:
    """128-bit digest of the sequence of words, as two longs."""
    digest = xxhash.xxh3_128_digest(b" ".join(text.lower().split()), SEED)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def slot_counts(text: bytes, width: int) -> bytes:
    """How many different shingles of a text fall in each slot of their hashes, up to ``FULL_SLOT``.

    A text has a slot for one to two of its shingles, within the bounds: more of them in a slot would rule out
    little, as any two texts fill such slots alike.
    """
    own = shingle_set(text, width)
    slots = min(MOST_SLOTS, max(FEWEST_SLOTS, (1 << int(own.size).bit_length()) // 2))
    counts = np.bincount((own % np.uint64(slots)).astype(np.int64), minlength=slots)
    return np.minimum(counts, FULL_SLOT).astype(np.uint8).tobytes()


def fingerprints(docs: DataFrame, width: int = SHINGLE, tables: int = 1, counted: int = 0) -> DataFrame:
    """``doc_id, body, class, other, prints``: id, a hash of the text that tells repeated ids apart, the two
    halves of the digest of its words, and the fingerprints; with ``counted`` also ``slots``, the slot counts of
    its shingles of so many words."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch.column("text"))
        prints = [fingerprint(text, width, tables) for text in texts]
        halves = np.array([words_digest(text) for text in texts], np.int64).reshape(-1, 2)
        flat = pa.array(np.concatenate(prints).view(np.int64))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(prints) + 1) * tables, pa.int32()), flat)
        slots = [pa.array([slot_counts(text, counted) for text in texts], pa.binary())] * bool(counted)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("body"), pa.array(halves[:, 0]), pa.array(halves[:, 1]), lists, *slots],
            ["doc_id", "body", "class", "other", "prints", *(["slots"] * bool(counted))])

    rows = docs.select("doc_id", F.xxhash64("text").alias("body"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(per_slice(work), f"doc_id {kind}, body long, class long, other long, prints array<long>"
                           + ", slots binary" * bool(counted))


def flips(groups: int, half: int = RADIUS // 2) -> dict[int, np.ndarray]:
    """Change of the bucket -> masks of the flips (up to ``half`` bits) that change it so."""
    masks: dict[int, list[int]] = {}
    for size in range(half + 1):
        for bits in combinations(range(64), size):
            change = mask = 0
            for bit in bits:
                change ^= 1 << (bit % groups)
                mask |= 1 << bit
            masks.setdefault(change, []).append(mask)
    return {change: np.array(found, np.uint64) for change, found in masks.items()}


def buckets_of(prints: np.ndarray, groups: int) -> np.ndarray:
    out = np.zeros(prints.size, np.int64)
    for group in range(groups):
        mask = np.uint64(sum(1 << bit for bit in range(group, 64, groups)))
        out |= (np.bitwise_count(prints & mask) & 1).astype(np.int64) << group
    return out


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable from each of n nodes over the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        while not np.array_equal(jumped := after[after], after):
            after = jumped
        if np.array_equal(after, root):
            return root
        root = after


def link_bucket(bucket: int, prints: np.ndarray, groups: int, masks: dict[int, np.ndarray],
                radius: int = RADIUS, spanning: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Links between the fingerprints whose variants meet in the bucket, as a forest.

    Without ``spanning`` they are candidates for a verification that some may fail: each fingerprint's link
    to the one it meets that meets most others, so that the copies of one text are held against that text.
    """
    prints = np.unique(prints)
    change = buckets_of(prints, groups) ^ bucket
    order = np.argsort(change, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(change[order]) != 0, [True]]))
    variants, owners = [], []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        mine = order[low:high]
        flip = masks[int(change[mine[0]])]
        variants.append((prints[mine][:, None] ^ flip[None, :]).ravel())
        owners.append(np.repeat(mine.astype(np.uint32), flip.size))
    every, owner = np.concatenate(variants), np.concatenate(owners)
    ranked = np.sort(every)
    met = ranked[1:][ranked[1:] == ranked[:-1]]
    if not met.size:
        return prints[:0], prints[:0]
    seen = np.zeros(1 << 22, bool)
    seen[met & np.uint64(seen.size - 1)] = True
    near = np.flatnonzero(seen[every & np.uint64(seen.size - 1)])
    met_by = np.bincount(owner[near], minlength=prints.size)
    hub_first = -met_by[owner[near]] if not spanning else np.zeros(near.size, np.int64)
    near = near[np.lexsort((owner[near], hub_first, every[near]))]
    value, who = every[near], owner[near].astype(np.int64)
    first = np.maximum.accumulate(np.where(np.concatenate([[True], value[1:] != value[:-1]]), np.arange(near.size), 0))
    a, b = who[first], who
    close = (a != b) & (np.bitwise_count(prints[a] ^ prints[b]) <= radius)
    pairs = np.unique(a[close] * prints.size + b[close])
    if not spanning:
        hub, member = pairs // prints.size, pairs % prints.size
        order = np.lexsort((hub, -met_by[hub], member))
        best = order[np.concatenate([[True], np.diff(member[order]) != 0])] if order.size else order
        return prints[hub[best]], prints[member[best]]
    root = forest(pairs // prints.size, pairs % prints.size, prints.size)
    other = np.flatnonzero(root != np.arange(prints.size))
    return prints[other], prints[root[other]]


def links(prints: DataFrame, spanning: bool = True) -> DataFrame:
    """``tab, a, b``: links that connect the different fingerprints of a table within the radius of each other."""
    count = prints.groupBy("tab").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    groups = min(32, max(4, math.ceil(math.log2(max(1, count) * 2081 / VARIANTS_PER_BUCKET))))
    masks = flips(groups)
    changes = np.array(sorted(masks), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("print").to_numpy(zero_copy_only=False)
            home = buckets_of(own.view(np.uint64), groups)
            shelf = batch.column("tab").to_numpy(zero_copy_only=False).astype(np.int64) << 32
            for low in range(0, own.size, 4096):
                where = shelf[low:low + 4096, None] | (home[low:low + 4096, None] ^ changes[None, :])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where.ravel()), pa.array(np.repeat(own[low:low + 4096], changes.size))],
                    ["bucket", "print"])

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        bucket = int(key[0])
        a, b = link_bucket(bucket & 0xFFFFFFFF, frame["print"].to_numpy().view(np.uint64), groups, masks,
                           spanning=spanning)
        return pd.DataFrame({"tab": np.full(a.size, bucket >> 32, np.int32), "a": a.view(np.int64), "b": b.view(np.int64)})

    return prints.select("tab", "print").mapInArrow(deal, "bucket long, print long") \
        .groupBy("bucket").applyInPandas(meet, "tab int, a long, b long")


def near_groups(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``doc_id, body, print, root, component_id`` of every row; ``root`` names the group."""
    rows = fingerprints(docs, width).select("doc_id", "body", F.col("prints")[0].alias("print"))
    rows = staged(rows, "prints")
    prints = staged(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "different")
    found = components(links(prints.select(F.lit(0).alias("tab"), "print")))
    rooted = prints.join(found.withColumnRenamed("node", "print"), "print", "left") \
        .withColumn("root", F.coalesce("root", "print"))
    rooted = staged(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = staged(rooted.select("print", "root").join(named, "root"), "groups")
    return rows.join(groups, "print")


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The different hashed shingles of a text, sorted; none without words."""
    words = text.lower().split()
    return np.unique(shingle_hashes(words, width)).astype(np.uint64) if words else np.empty(0, np.uint64)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``class, shingles``: the different hashed shingles of each text."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(text, width) for text in utf8(batch.column("text"))]
        bounds = np.cumsum([0, *(x.size for x in sets)])
        flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))
        return pa.RecordBatch.from_arrays([batch.column("class"), lists], ["class", "shingles"])

    return docs.mapInArrow(per_slice(work), "class long, shingles array<long>")


def repeat_levels(docs: DataFrame, width: int) -> np.ndarray:
    """How often shingles of a slot of hashes occur in a sample of the texts, in steps of a fourth power of two."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> pa.RecordBatch:
            slots, times = np.unique(np.concatenate(held), return_counts=True)
            more = times > 1
            return pa.RecordBatch.from_arrays([pa.array(slots[more].astype(np.int32)), pa.array(times[more])], ["slot", "n"])

        held, size = [np.empty(0, np.uint64)], 0
        for batch in batches:
            for text in utf8(batch.column("text")):
                held.append(shingle_set(text, width) >> np.uint64(64 - SLOT_BITS))
                size += held[-1].size
                if size > 1 << 20:
                    yield counted()
                    held, size = [np.empty(0, np.uint64)], 0
        yield counted()

    sample = docs.filter(F.pmod(F.xxhash64("text"), F.lit(COUNTED)) == 0).select("text")
    slots = sample.mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).filter("n > 3").toArrow()
    levels = np.zeros(1 << SLOT_BITS, np.uint8)
    levels[slots.column("slot").to_numpy()] = 4 * np.log2(slots.column("n").to_numpy())
    return levels


def prefixes(docs: DataFrame, width: int, likeness: float) -> DataFrame:
    """``shingle, class, size, place``: the first shingles of each text, one of which every similar text has among its own."""
    shared = docs.sparkSession.sparkContext.broadcast(repeat_levels(docs, width))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        levels, none = shared.value, np.empty(0, np.int64)
        found, classes, sizes, places = [none.view(np.uint64)], [none], [none], [none]
        for text in utf8(batch.column("text")):
            own = shingle_set(text, width)
            n = own.size
            if n:
                first = np.argsort(levels[own >> np.uint64(64 - SLOT_BITS)], kind="stable")
                first = first[:n - math.ceil(likeness * n - 1e-9) + 1]
                found.append(own[first])
                classes.append(np.full(first.size, words_digest(text)[0]))
                sizes.append(np.full(first.size, n))
                places.append(np.arange(first.size))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(classes)),
             pa.array(np.concatenate(sizes).astype(np.int32)), pa.array(np.concatenate(places).astype(np.int32))],
            ["shingle", "class", "size", "place"])

    return docs.select("text").mapInArrow(per_slice(work), "shingle long, class long, size int, place int")


def by_shingle(posts: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The rows by shingle and class without repeats, the place of each row's first of the shingle, and its last."""
    shingle, owner = (posts.column(name).to_numpy() for name in ("shingle", "class"))
    order = np.lexsort((owner, shingle))
    shingle, owner = shingle[order], owner[order]
    once = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])])[:shingle.size]
    order, shingle = order[once], shingle[once]
    edges = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1], [True]])) if shingle.size else np.zeros(1, np.int64)
    counts = np.diff(edges)
    return posts.take(pa.array(order)), np.repeat(edges[:-1], counts), np.repeat(edges[1:] - 1, counts)


def met_posts(docs: DataFrame, width: int, likeness: float) -> DataFrame:
    """Stored rows of :func:`prefixes` whose shingle several classes have, with ``bucket`` and the ``many`` that have it."""
    def meet(posts: pa.Table) -> pa.Table:
        posts, first, last = by_shingle(posts)
        posts = posts.append_column("many", pa.array((last - first + 1).astype(np.int32)))
        return posts.filter(pa.array(last > first))

    parts = 4 * shuffle_parts(docs.sparkSession)
    posts = prefixes(docs, width, likeness).withColumn("bucket", F.pmod(F.xxhash64("shingle"), F.lit(parts)))
    return staged(posts.groupBy("bucket").applyInArrow(
        meet, "shingle long, class long, size int, place int, bucket long, many int"), "posts")


def meetings(posts: DataFrame, found: DataFrame, low: int, high: int, likeness: float) -> DataFrame:
    """``a, b``: pairs not connected yet that may be similar, of texts ``low`` to ``high - 1`` of a shingle with later ones."""
    least = likeness / (1 + likeness)

    def meet(rows: pa.Table) -> pa.Table:
        rows, first, _ = by_shingle(rows)
        owner, root, size, place = (rows.column(name).to_numpy().astype(np.int64) for name in ("class", "root", "size", "place"))
        rank, pairs = np.arange(first.size) - first, [np.empty((0, 2), np.int64)]
        for hub in range(low, high):
            b = np.flatnonzero(rank > hub)
            if not b.size:
                break
            a = first[b] + hub
            # of the shingles from the common one on, enough must be common
            rest = np.minimum(size[a] - place[a], size[b] - place[b])
            may = (root[a] != root[b]) & (rest >= least * (size[a] + size[b]) - 1e-9)
            pairs.append(np.unique(np.stack([owner[a[may]], owner[b[may]]], axis=1), axis=0))
        every = np.unique(np.concatenate(pairs), axis=0)
        return pa.table({"a": every[:, 0], "b": every[:, 1]})

    rooted = posts.filter(F.col("many") > low + 1).join(
        small(found.withColumnRenamed("node", "class")), "class", "left").withColumn("root", F.coalesce("root", "class"))
    return rooted.groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def ruled_out(left: np.ndarray, right: np.ndarray, likeness: float) -> np.ndarray:
    """Which pairs of slot counts, a row each, are of sets less similar than that."""
    full = (left == FULL_SLOT).any(axis=1) | (right == FULL_SLOT).any(axis=1)
    slots = min(left.shape[1], right.shape[1])
    # slots are powers of two: those of the larger vector fall together into those of the smaller
    left, right = (x.reshape(len(x), -1, slots).sum(axis=1, dtype=np.uint16) for x in (left, right))
    shared = np.minimum(left, right).sum(axis=1, dtype=np.int64)
    sizes = left.sum(axis=1, dtype=np.int64) + right.sum(axis=1, dtype=np.int64)
    return ~full & (shared * (1 + likeness) < likeness * sizes - 1e-6)


def perhaps_similar(classes: DataFrame, pairs: DataFrame, likeness: float) -> DataFrame:
    """The pairs that their slot counts do not rule out.

    Two sets share at most the lesser count of every slot, so the sum of these bounds what they share. A full
    slot bounds nothing: such pairs stay.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(side) for side in ("left", "right")]
            many = [pc.binary_length(side).to_numpy().astype(np.int64) for side in sides]
            shape, may = many[0] * (2 * MOST_SLOTS) + many[1], np.ones(batch.num_rows, bool)
            for one in np.unique(shape):
                same = np.flatnonzero(shape == one)
                step = max(1, SLICE_BYTES // max(many[0][same[0]], many[1][same[0]]))
                for low in range(0, same.size, step):
                    at = same[low:low + step]
                    left, right = (np.frombuffer(b"".join(side.take(pa.array(at)).to_pylist()), np.uint8).reshape(at.size, -1)
                                   for side in sides)
                    may[at] = ~ruled_out(left, right, likeness)
            yield batch.select(["a", "b"]).filter(pa.array(may))

    counts = classes.select("class", "slots")
    both = pairs.join(counts.toDF("a", "left"), "a").join(counts.toDF("b", "right"), "b")
    return both.select("a", "b", "left", "right").mapInArrow(work, "a long, b long")


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, likeness: float, width: int) -> DataFrame:
    """The pairs of classes whose representatives are similar, stored.

    Slot counts rule most pairs out before any text is read; the others are held against each other by all
    their shingles.
    """
    pairs = staged(perhaps_similar(classes, pairs, likeness), "perhaps")
    needed = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    wanted = staged(classes.join(needed, "class").select(
        "class", F.col("own.doc_id").alias("id"), F.col("own.body").alias("hash")), "wanted")
    texts = docs.select("doc_id", F.xxhash64("text").alias("body"), "text").join(
        small(wanted), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("body") == F.col("hash"))) \
        .select("class", "text")
    sets = staged(shingle_sets(texts, width).dropDuplicates(["class"]), "sets")
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("left")), "a") \
        .join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("right")), "b")
    shared = F.size(F.array_intersect("left", "right"))
    alike = (shared >= likeness * (F.size("left") + F.size("right") - shared))
    return staged(both.filter(alike).select("a", "b"), "alike")


def similar_groups(docs: DataFrame, likeness: float = LIKENESS, width: int = WORDS, tables: int = TABLES,
                   candidate_width: int = CANDIDATE_WORDS) -> DataFrame:
    """``doc_id, body, class, root`` of every row: texts of one group are chained by a likeness of at least so much.

    Rows with the same sequence of words are one class, represented by its smallest id; candidate pairs of
    classes are verified by the shingles of their representatives.
    """
    rows = staged(fingerprints(docs, candidate_width, tables, width), "prints")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body")
    same = F.when(F.min("other") == F.max("other"), F.min(own)).otherwise(
        F.raise_error(F.lit("two texts share half a digest: change SEED")))
    classes = staged(rows.groupBy("class").agg(same.alias("own"), F.first("prints").alias("prints"),
                                                   F.first("slots").alias("slots")), "classes")
    found = components(verified(docs, classes, fingerprint_pairs(classes), likeness, width))
    posts = met_posts(docs, width, likeness)
    most = posts.agg(F.coalesce(F.max("many"), F.lit(0))).first()[0]
    low, high = 0, FIRST_HUBS
    while low + 1 < most:
        pairs = staged(meetings(posts, found, low, high, likeness), "meetings")
        if not pairs.isEmpty():
            alike = verified(docs, classes, pairs, likeness, width)
            found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(alike))
        low, high = high, high * MORE_HUBS
    return rows.select("doc_id", "body", "class").join(found.withColumnRenamed("node", "class"), "class", "left") \
        .withColumn("root", F.coalesce("root", "class"))


def fingerprint_pairs(classes: DataFrame) -> DataFrame:
    """``a, b``: stored pairs of classes that meet in a fingerprint, one for each fingerprint and bucket."""
    shelved = classes.select("class", F.posexplode("prints").alias("tab", "print"))
    firsts = staged(shelved.groupBy("tab", "print").agg(F.min("class").alias("class")), "firsts")
    met = staged(links(firsts, spanning=False).distinct(), "met")
    left = firsts.select("tab", F.col("print").alias("a"), F.col("class").alias("left"))
    right = firsts.select("tab", F.col("print").alias("b"), F.col("class").alias("right"))
    equal = shelved.join(firsts.withColumnRenamed("class", "left"), ["tab", "print"]).filter("class <> left")
    pairs = met.join(left, ["tab", "a"]).join(right, ["tab", "b"]).select("left", "right") \
        .unionByName(equal.select("left", F.col("class").alias("right"))).filter("left <> right")
    return staged(pairs.select(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b")).distinct(), "pairs")


def near_components(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint in hex and the smallest id in its component."""
    return near_groups(docs.select("doc_id", "text")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group of similar texts, the one with the smallest id; columns as they were.

    Of repeated rows (the same id and text) one stays.
    """
    own = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("body").alias("text_hash"), "times")
    with passing(docs.sparkSession):
        least = similar_groups(docs).groupBy("root", "doc_id", "body").agg(F.count("*").alias("times")) \
            .groupBy("root").agg(F.min(own).alias("stay"))
        stay = staged(least.select("stay.*"), "stay", keep=True)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"))
    same = rows.join(stay.select(F.col("id").alias("of"), F.col("text_hash").alias("hash"), "times"),
                     F.col("id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("hash")))
    once = same.filter("times = 1")
    if not stay.filter("times > 1").isEmpty():
        once = once.unionByName(same.filter("times > 1").dropDuplicates(["id", "text_hash"]))
    return once.select("row.*")
