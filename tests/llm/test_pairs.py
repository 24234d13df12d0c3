"""Exact, near and substring deduplication against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import ODD
from pyspark.sql import functions as F

from candlelake.llm import components, exact, simhash, substrings

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORDS.findall(lower)
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def joined(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in pairs:
        root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_exact_groups_of_the_sample(documents, texts):
    groups = defaultdict(list)
    for i, text in texts.items():
        groups[SPACES.sub(" ", text)].append(i)
    want = {(i, min(ids), len(ids), i == min(ids), sha(text)) for text, ids in groups.items() for i in ids}
    assert {tuple(r) for r in exact.exact_digests(documents).collect()} == want


def test_exact_groups_of_odd_rows(make):
    rows = exact.exact_digests(make(ODD)).collect()
    assert len(rows) == len(ODD)
    by_text = defaultdict(list)
    for r in rows:
        by_text[r.text_sha256].append(r)
    for i, text in ODD:
        group = by_text[sha(SPACES.sub(" ", text or ""))]
        assert sum(r.kept for r in group) == 1
        assert {r.group_size for r in group} == {len(group)}
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert {r.keep_id for r in group} == {min(ids, default=None)}
    kept = exact.drop_copies(make(ODD))
    assert kept.columns == make(ODD).columns
    assert kept.count() == len(by_text)


def test_exact_groups_when_every_row_is_routed(make, monkeypatch):
    monkeypatch.setattr(exact, "may_repeat", lambda spark, bitmap: exact.F.lit(True))
    assert exact.drop_copies(make(ODD)).count() == len({SPACES.sub(" ", text or "") for _, text in ODD})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**20 - 1), min_size=1, max_size=60), min_size=1, max_size=5),
       st.integers(1, 12))
def test_filters_merge_without_loss(parts, skip):
    block = 5 % (1 << skip)
    arrays = [(np.array(p, np.uint64) * np.uint64(977) % np.uint64(1 << 40)) | np.uint64(block << (64 - skip)) for p in parts]
    filters = [exact.QuotientFilter.unpack(exact.QuotientFilter.of(a).pack(skip), skip) for a in arrays]
    merged = exact.QuotientFilter.merge(filters)
    prints, counts = np.unique(np.concatenate(arrays), return_counts=True)
    assert (merged.prints == prints).all() and (merged.counts == counts).all()


def test_simhash_of_the_sample(documents, texts):
    prints = {i: fingerprint(text) for i, text in texts.items()}
    ids = sorted(texts)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (prints[a] ^ prints[b]).bit_count() <= 4]
    root = joined(pairs, ids)
    least = {}
    for i in ids:
        least[root[i]] = min(least.get(root[i], i), i)
    want = {(i, f"{prints[i]:016x}", least[root[i]]) for i in ids}
    assert {tuple(r) for r in simhash.near_components(documents).collect()} == want


def test_simhash_of_odd_rows(make):
    rows = simhash.near_components(make(ODD)).collect()
    assert sorted(r.fingerprint for r in rows) == sorted(f"{fingerprint(t):016x}" for _, t in ODD)
    blank = {r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert blank == {1}
    kept = simhash.drop_near_copies(make(ODD))
    assert kept.columns == make(ODD).columns
    assert kept.count() == len({tuple((t or "").split()) for _, t in ODD})


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_similar_texts_are_grouped_and_others_left_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    group = {r.doc_id: r.root for r in simhash.similar_groups(docs).collect()}
    ids = sorted(sets)
    alike = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b]))
             and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want, got = joined(alike, ids), defaultdict(set)
    for i in ids:
        got[group[i]].add(want[i])
    assert all(len(roots) == 1 for roots in got.values())
    near = [(a, b) for a, b in alike if sets[a] != sets[b]]
    assert near and sum(group[a] == group[b] for a, b in near) >= 0.9 * len(near)
    assert all(group[a] == group[b] for a, b in alike if sets[a] == sets[b])


@pytest.mark.parametrize("groups", [4, 8, 13])
def test_buckets_link_a_dense_cluster_and_a_chain(groups):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 12, dtype=np.uint64)
    near = [c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), False))) for c in centre for _ in range(25)]
    chain = [np.uint64((1 << k) - 1) for k in range(0, 64, 4)]
    prints = np.unique(np.array([*centre, *near, *chain], np.uint64))
    masks = simhash.flips(groups)
    assert sum(len(m) for m in masks.values()) == 2081
    home = simhash.buckets_of(prints, groups)
    met = []
    for bucket in range(1 << groups):
        mine = prints[np.isin(home ^ bucket, list(masks))]
        if mine.size:
            met += list(zip(*simhash.link_bucket(bucket, mine, groups, masks), strict=True))
    assert all((int(a) ^ int(b)).bit_count() <= 4 for a, b in met) or met
    every = [(a, b) for k, a in enumerate(prints) for b in prints[k + 1:] if (int(a) ^ int(b)).bit_count() <= 4]
    got, want = joined(met, prints), joined(every, prints)
    assert len(set(got.values())) == len(set(want.values()))
    assert all(got[a] == got[b] for a, b in every)


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 90)],
    [(i * 37 % 101, i * 53 % 101) for i in range(70)]])
def test_components(spark, links):
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for link in links for n in link}
    root = joined(links, nodes)
    least = {}
    for n in nodes:
        least[root[n]] = min(least.get(root[n], n), n)
    assert got == {n: least[root[n]] for n in nodes if least[root[n]] != n}


def brute_repeats(rows):
    seen, out = {}, []
    for key, text in sorted(rows):
        words = text.encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k:k + 20])
            if seen.setdefault(window, (key, k)) != (key, k):
                gone[k:k + 20] = [True] * 20
        out.append((len(words), sum(gone), hashlib.sha256(
            b" ".join(w for w, g in zip(words, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def test_substrings_of_the_sample(documents, texts):
    got = sorted(tuple(r)[1:] for r in substrings.repeat_report(documents.repartition(4)).collect())
    assert got == brute_repeats(texts.items())


def test_substrings_within_and_across_documents(make):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"start{i} {passage} end{i}") for i in range(12)] + [(50, f"{passage} {passage}"), (51, "x " * 100),
            (52, passage[:60]), (53, " ".join(f"p{i}" for i in range(5, 24))), (54, " ".join(f"p{i}" for i in range(5, 25)))]
    got = sorted(tuple(r)[1:] for r in substrings.repeat_report(make(rows, parts=5)).collect())
    assert got == brute_repeats(rows)


def test_substrings_of_odd_rows(make):
    got = {r.doc_id: r for r in substrings.repeat_report(make(ODD)).collect()}
    assert substrings.repeat_report(make(ODD)).count() == len(ODD)
    assert (got[1].n_words, got[1].kept_sha256) == (0, sha(""))
    # all windows of the long run repeat its first; repeated rows of one id are one document
    assert (got[8].n_words, got[8].n_removed) == (30_000, 29_999)
    long = " ".join(f"q{i}" for i in range(30))
    twice = substrings.repeat_report(make([(1, long), (1, long), (None, long)])).collect()
    assert {(r.doc_id, r.n_removed) for r in twice} == {(1, 0), (None, 30)}


def test_substrings_of_texts_whose_short_hashes_collide(spark, make):
    """Rows of one id (or none) with different texts are told apart by more than 32 bits."""
    texts = spark.range(120_000).select(F.concat(F.lit("w"), "id").alias("w")).select(
        F.expr("concat_ws(' ', transform(sequence(1, 64), i -> concat(w, '_', i)))").alias("long"),
        F.concat("w", F.lit(" "), "w").alias("short"))
    long, short = texts.select(F.hash("long").alias("h"), "long"), texts.select(F.hash("short").alias("h"), "short")
    pairs = [tuple(r) for r in long.join(short, "h").select("long", "short").collect()][:4]
    assert pairs
    for a, b in pairs:
        rows = [(None, a), (None, b), (7, a), (7, b), (2**63 - 1, a), (2**63 - 1, b), (3, a + " tail")]
        got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substrings.repeat_report(make(rows)).collect()), key=repr)
        assert got == sorted([(3, 65, 0), *((i, n, n if n == 64 else 0) for i in (7, 2**63 - 1, None) for n in (64, 2))],
                             key=repr)


def test_empty_tables(make):
    none = make([(1, "x")]).limit(0)
    for run in (exact.exact_digests, exact.drop_copies, simhash.near_components, simhash.drop_near_copies,
                substrings.repeat_report):
        assert run(none).collect() == []
