"""The search for similar texts against brute force, on clusters, passages and texts ruled by one word pair."""

from __future__ import annotations

import random

import numpy as np
import pytest
from llm.test_pairs import joined, shingles

from candlelake.llm import simhash


def words(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def template_cluster(rng, members=150):
    """Many texts of one template, most pairs just not similar, each with a twin."""
    body, out = words(rng, 400), []
    for _ in range(members):
        own = list(body)
        for place in rng.sample(range(400), 5):
            own[place] = words(rng, 1)[0]
        twin = list(own)
        twin[rng.randrange(400)] = words(rng, 1)[0]
        out += [own, twin]
    return out


def passages(rng):
    """Texts with a paragraph appended, cut off or replaced, at a likeness from 0.78 to 0.9."""
    out = []
    for k in range(60):
        text, size = words(rng, 300), 32 + k
        out += [text, [text + words(rng, size), text[:300 - size], text[:100] + words(rng, size // 2) + text[100 + size // 2:]][k % 3]]
    return out


def ruled(rng):
    """Different texts that one word pair fills by more than half, and near copies of them."""
    out = [["-"] * 600 + words(rng, 500) for _ in range(20)]
    return out + [[*text[:-20], *words(rng, 20)] for text in out[:10]]


@pytest.mark.parametrize("kind", [template_cluster, passages, ruled])
def test_similar_texts_are_those_of_brute_force(make, kind):
    rng = random.Random(11)
    rows = [(i, " ".join(text)) for i, text in enumerate(kind(rng))]
    sets = {i: shingles(text) for i, text in rows}
    alike = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert alike
    want, got = joined(alike, sets), {r.doc_id: r.root for r in simhash.similar_groups(make(rows)).collect()}
    assert len({(want[i], got[i]) for i in sets}) == len(set(want.values())) == len(set(got.values()))


def test_slot_counts_rule_out_no_similar_pair():
    rng, ruled = random.Random(3), 0
    for n in (1, 3, 40, 200, 900, 5_000, 40_000, 4_300_000 // 254):
        text = words(rng, n)
        for m in (0, 1, n // 30, n // 9, n // 4, n):
            at = rng.randrange(n - m + 1)
            for other in (text[:at] + words(rng, m) + text[at + m:], text + words(rng, m), text[:n - m] or ["w"]):
                a, b = shingles(" ".join(text)), shingles(" ".join(other))
                left, right = (simhash.slot_counts(" ".join(x).encode(), simhash.WORDS) for x in (text, other))
                left, right = (np.frombuffer(x, np.uint8).reshape(1, -1) for x in (left, right))
                out = bool(simhash.ruled_out(left, right, 0.8)[0])
                assert not (out and len(a & b) >= 0.8 * len(a | b))
                ruled += out
    assert ruled > 40


def test_full_slots_bound_nothing():
    full, some = np.full((1, 64), 255, np.uint8), np.zeros((1, 128), np.uint8)
    assert not simhash.ruled_out(full, some, 0.8)[0]
    assert simhash.ruled_out(full - 1, some, 0.8)[0]


def test_large_groups_are_searched_to_the_end(make, monkeypatch):
    monkeypatch.setattr(simhash, "FIRST_HUBS", 1)
    monkeypatch.setattr(simhash, "MORE_HUBS", 2)
    monkeypatch.setattr(simhash, "fingerprint_pairs", lambda classes: classes.sparkSession.createDataFrame([], "a long, b long"))
    rng = random.Random(5)
    rows = [(i, " ".join(text)) for i, text in enumerate(template_cluster(rng, 20) + passages(rng)[:40])]
    sets = {i: shingles(text) for i, text in rows}
    alike = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want, got = joined(alike, sets), {r.doc_id: r.root for r in simhash.similar_groups(make(rows)).collect()}
    assert len({(want[i], got[i]) for i in sets}) == len(set(want.values())) == len(set(got.values()))


def test_one_text_of_each_group_of_the_sample_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r.doc_id: shingles(r.text or "") for r in docs.collect()}
    ids = sorted(sets)
    root = joined([(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
                   if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])], ids)
    least = {}
    for i in ids:
        least.setdefault(root[i], i)
    assert sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect()) == sorted(least.values())


@pytest.mark.parametrize("repeats", [1, 3])
def test_of_repeated_rows_one_stays(make, repeats):
    rng = random.Random(8)
    texts = [" ".join(words(rng, 40)) for _ in range(6)]
    rows = [(i % 5, text) for i, text in enumerate(texts)] + [(9, texts[0]), (None, texts[1]), (None, None), (None, "")]
    kept = simhash.drop_near_copies(make(rows * repeats)).select("doc_id", "text").collect()
    empty = [r for r in kept if not r.text]
    assert len(empty) == 1 and empty[0].doc_id is None
    assert sorted((r.doc_id, r.text) for r in kept if r.text) == sorted((i % 5, text) for i, text in enumerate(texts))
