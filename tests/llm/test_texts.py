"""Personal data, fingerprints, tokens, toxicity, chat and mixing against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from check import compare, connect
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import ODD

import corpus_pipeline
from candlelake.llm import chat, mixing, pieces, queries, sanitise, spotsigs, token_counts, toxicity

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
HARD = [
    "a@b.c_d@e.f x@@y.z .@-.-. q@w. e@r..t a%b+c@d-e.f-g.h",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3.0255 999.1.2.3.4 0001.02.3.4 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 41111111111111111 1 2 3",
    "+1 (407) 555-7710 +123 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 ++1 23456789- 🙂+49 30 1234567.",
    "x" * 3000 + "@" + "y" * 3000, "1" * 5000, "1." * 4000, "+1" + " 2" * 3000, "🙂" * 50 + " é@ü.de a@b.de"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    out = {}
    for kind, pattern in KINDS.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) \
                    or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)) \
                    or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out[kind].append(f"{kind}:{m.start()}:{m.end()}")
    return out


def same_spans(row, text):
    want = base(text)
    every = ",".join(x for spans in want.values() for x in spans)
    return [row[f"n_{k}"] for k in KINDS] == [len(want[k]) for k in KINDS] \
        and row.base_sha256 == sha(every) and (row.spans == every or row.spans.startswith(every and every + ","))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, folder, name):
    assert compare(spark, connect(folder), folder, name, queries.QUERIES[name], queries.ORACLES[name]) == ""


def test_base_spans(documents, texts, make):
    assert all(same_spans(r, texts[r.doc_id]) for r in sanitise.span_report(documents).collect())
    rows = [(i, t) for i, t in enumerate(HARD)] + [(100 + i, t) for i, (_, t) in enumerate(ODD)]
    got = sanitise.span_report(make(rows)).collect()
    assert len(got) == len(rows) and all(same_spans(r, dict(rows)[r.doc_id]) for r in got)


def test_terms_that_disclose_are_marked(make):
    rows = [(i, f"the contact zorblatt manager of sales writes from boss.{i % 2}@corp.example daily") for i in range(8)]
    rows += [(100 + i, f"the manager of sales number {i} writes daily from here to the contact") for i in range(200)]
    docs = make(rows)
    found = {r.doc_id: r.spans for r in sanitise.span_report(docs).collect()}
    at = rows[0][1].index("zorblatt")
    # one of two addresses has it half of the time: most of its information, not all
    assert f"generalise:{at}:{at + 8}" in found[0] and "manager" not in found[0]
    assert all(found[i] == "" for i in range(100, 300))
    clean = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert clean[0] == "the contact [TERM] manager of sales writes from [EMAIL] daily"
    assert clean[150] == dict(rows)[150] and len(clean) == len(rows)
    strict = sanitise.found_spans(docs)
    shares = {(r.entity, r.term): r.disclosed for r in sanitise.disclosures(docs, strict).collect()}
    n, e, t, both = 208, 4, 8, 4
    want = math.log(n * both / (e * t)) / math.log(n / e)
    assert abs(shares["email:boss.0@corp.example", "zorblatt"] - want) < 1e-9


def test_spot_signatures(documents, texts):
    got = {r.doc_id: r for r in spotsigs.edited_report(documents).collect()}
    ids = sorted(texts, reverse=True)
    sets = {i: set(re.findall(".{8}", r.fingerprint.split(":")[1])) for i, r in got.items()}
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        text, cut = texts[i], len(texts[i]) // 3
        edited = text[:len(text) - cut] + texts[after][:cut]
        row = got[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), sha(edited))
        assert row.near_next == pytest.approx(likeness(sets[i], sets[after]))
        assert row.near_edited == pytest.approx(
            likeness(sets[i], set(re.findall(".{8}", row.edited_fingerprint.split(":")[1]))))
    assert sum(r.near_edited for r in got.values()) / len(got) > 0.4
    assert sum(r.near_next for r in got.values()) / len(got) < 0.05
    by_text = defaultdict(set)
    for i, text in texts.items():
        by_text[text].add(got[i].fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())


def likeness(a, b):
    return len(a & b) / len(a | b)


def test_spot_signature_chains(make):
    text = "The cat sat on the big red mat, and a dog saw it in the old park by the river bank."
    row = spotsigs.fingerprint_classes(make([(1, text), (2, text.upper()), (3, "short words")])).collect()
    sizes = {r.doc_id: len(r.spots) for r in row}
    words, spots = re.findall(r"\w+", text.lower()), set()
    for k, word in enumerate(words):
        chain = [w for w in words[k + 1:k + 9] if w not in spotsigs.ANCHORS][:2]
        if word in spotsigs.ANCHORS and len(chain) == 2:
            spots.add((word, *chain))
    assert sizes == {1: len(spots), 2: len(spots), 3: 2}
    assert {r.class_id for r in row if r.doc_id < 3} == {1}


def test_similar_classes(documents):
    classes = spotsigs.fingerprint_classes(documents)
    sets = {r.class_id: frozenset(r.spots) for r in classes.collect()}
    keys = sorted(sets)
    want = {(a, b) for k, a in enumerate(keys) for b in keys[k + 1:] if len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])}
    assert want and {(r.a, r.b) for r in spotsigs.similar_classes(classes, 0.5).collect()} == want


def test_spot_signatures_of_odd_rows(make):
    got = spotsigs.edited_report(make(ODD)).collect()
    assert len(got) == len(ODD) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    prints = Counter(r.fingerprint for r in got)
    assert len(prints) == len({" ".join(re.findall(r"\w+", (t or "").lower())) or (t or "") for _, t in ODD})


@pytest.mark.parametrize("ids", [
    [*range(300), 1 << 62, -(1 << 62)], [k ** 6 for k in range(200)], [7] * 50 + [*range(8, 60)], [-3], [None, 4, None, 2]])
def test_ranges_hold_about_as_many_rows_whatever_the_ids(make, ids):
    rows = [(i, f"text {k} of the many on a shelf {k * 7}") for k, i in enumerate(ids)]
    docs = make(rows).select("doc_id", "text")
    placed = docs.withColumn("range", spotsigs.range_of(spotsigs.id_bounds(docs))).collect()
    known = sorted((r for r in placed if r.doc_id is not None), key=lambda r: r.doc_id)
    assert all(a.range <= b.range and (a.doc_id != b.doc_id or a.range == b.range) for a, b in pairwise(known))
    most = max(Counter(r.range for r in placed).values())
    assert most <= max(3 * len(ids) ** 0.5, max(Counter(ids).values()) + 3 * len(ids) ** 0.5)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    after = {row: following[1] for row, following in zip(order, order[1:] + order[:1], strict=True)}
    got = spotsigs.with_next(docs, spotsigs.spotted, "text", "spots").collect()
    assert {(r.doc_id, r.text): r.next.text for r in got} == after and len(got) == len(rows)


def test_pieces_are_the_library_s(documents, texts, make):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    odd = make([(i, t) for i, (_, t) in enumerate(ODD)])
    for docs, plain in ((documents, texts), (odd, {i: t or "" for i, (_, t) in enumerate(ODD)})):
        rows = pieces.encode_texts(docs, queries.piece_model()).collect()
        assert len(rows) == len(plain)
        for row in rows:
            ids = library.encode(plain[row.row.doc_id])
            assert row.ids == ids and row.decoded == library.decode(ids)
        digests = {r.doc_id: r for r in pieces.encoded_digests(docs, queries.piece_model()).collect()}
        for i, text in plain.items():
            ids = library.encode(text)
            assert tuple(digests[i]) == (i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


def test_chunk_table_starts_again_when_full():
    table, library = pieces.ChunkTable(queries.piece_model(), limit=3), sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    for text in ("one two three four five", "", "six  seven", "one\n two▁x   "):
        ids, bounds = table.encode([text, text])
        assert ids.tolist() == 2 * library.encode(text) and bounds[1] == len(library.encode(text))


def test_chunk_table_is_bounded_by_its_bytes():
    table = pieces.ChunkTable(queries.piece_model(), limit=1 << 20)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    for k in range(40):
        text = chr(0x4E00 + k) * 100_000
        assert table.encode([text])[0].tolist() == library.encode(text)
        assert table.held <= (1 << 20) + 1_000_000 and len(table.codes) < 40


def test_texts_are_encoded_in_small_blocks():
    words = [chr(97 + k % 26) * (k % 7 + 1) for k in range(100)]
    texts = [" ".join(words[(i * k) % 100] for k in range(1_000)) for i in range(1_000)]
    rows = pa.StructArray.from_arrays([pa.array(range(1_000)), pa.array(texts)], ["doc_id", "text"])
    run = pieces.encoder(queries.piece_model(), True, 1)
    assert len(list(run(iter([pa.RecordBatch.from_arrays([rows[:2]], ["row"])])))) == 1
    tracemalloc.start()
    try:
        found = [(batch.column("row").field(0).to_pylist(), batch.column("decoded").to_pylist())
                 for batch in run(iter([pa.RecordBatch.from_arrays([rows], ["row"])]))]
        assert tracemalloc.get_traced_memory()[1] < 80 << 20
    finally:
        tracemalloc.stop()
    assert [i for ids, _ in found for i in ids] == list(range(1_000)) and [t for _, part in found for t in part] == texts


def test_pieces_take_a_text_column_of_any_case(spark):
    docs = spark.createDataFrame([(1, "one two", 3), (2, None, 4)], "doc_id long, Text string, ids int")
    rows = pieces.encode_texts(docs, queries.piece_model()).orderBy("row.doc_id").collect()
    assert [(r.row.Text, r.row.ids, r.decoded) for r in rows] == [("one two", 3, "one two"), (None, 4, "")]


def test_grams_are_counted_in_small_blocks():
    texts = [" ".join(f"w{(i * k) % 9973}" for k in range(300)) for i in range(1, 601)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 3 == 0 for i in range(600)]).cast(pa.int32())], ["text", "toxic"])
    tracemalloc.start()
    try:
        found = list(toxicity.block_counts(iter([batch])))
        assert tracemalloc.get_traced_memory()[1] < 60 << 20
    finally:
        tracemalloc.stop()
    counts, whole = Counter(), Counter()
    for part in found:
        for gram, n_toxic, n_clean in zip(*(c.to_pylist() for c in part.columns), strict=True):
            counts[gram, 1], counts[gram, 0] = counts[gram, 1] + n_toxic, counts[gram, 0] + n_clean
    for i, text in enumerate(texts):
        codes, _ = toxicity.prepared([text])
        for gram in set(np.concatenate([every for every, _ in toxicity.grams(codes)]).view(np.int64).tolist()):
            whole[gram, int(i % 3 == 0)] += 1
    assert +counts == whole


def test_long_words_are_counted_but_not_kept(make, monkeypatch):
    monkeypatch.setattr(token_counts, "LONGEST_KNOWN", 5)
    got = token_counts.token_counts(make([(1, "short longerword longerword"), (2, "longerword short")]), queries.piece_model())
    counts = {r.doc_id: (r.n_words, r.n_tokens) for r in got.collect()}
    one = {w: token_counts.token_counts(make([(1, w)]), queries.piece_model()).first().n_tokens for w in ("short", "longerword")}
    assert counts == {1: (3, one["short"] + 2 * one["longerword"]), 2: (2, one["short"] + one["longerword"])}


def greedy(word, vocabulary):
    count = at = 0
    while at < len(word):
        end = next((j for j in range(len(word), at, -1) if word[at:j] in vocabulary), None)
        if end is None:
            return 0
        at, count = end, count + 1
    return count


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.lists(st.text("abcd", max_size=14), max_size=12))
def test_automaton_is_greedy_longest_match(vocabulary, words):
    matcher = token_counts.LongestMatch(vocabulary)
    assert [matcher.count(w) for w in words] == [greedy(w, vocabulary) for w in words]


def test_token_counts(documents, texts, make):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    vocabulary = {library.id_to_piece(i) for i in range(library.get_piece_size())
                  if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))}
    odd = {i: t or "" for i, (_, t) in enumerate(ODD)}
    for docs, plain in ((documents, texts), (make([*odd.items()]), odd)):
        for row in token_counts.token_counts(docs, queries.piece_model()).collect():
            words = re.findall(r"[^\x20\x09-\x0D]+", plain[row.doc_id])
            counts = [greedy("▁" + w, vocabulary) if len(w) < 1000 else None for w in words]
            if None not in counts:
                assert tuple(row)[1:] == (len(words), sum(max(1, c) for c in counts), counts.count(0))


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    rows = toxicity.toxicity_report(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.held_out == held_out(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    label = {r.doc_id: r.toxic for r in labels.collect()}
    seen = Counter((label[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in label)
    assert seen[1, 1] >= 0.75 * (seen[1, 1] + seen[1, 0])
    assert seen[0, 1] <= 0.01 * (seen[0, 0] + seen[0, 1])


def test_toxicity_of_odd_rows(spark, make):
    rows = [(i, f"calm words number {i}") for i in range(40)] + [(100 + i, f"you idiot number {i}") for i in range(40)]
    labels = spark.createDataFrame(
        [(i, int(i >= 100)) for i, _ in rows] + [(None, 1), (7, None), (999, 1), (101, 1)], "doc_id long, toxic int")
    docs = make(rows + ODD)
    got = toxicity.toxicity_report(docs, labels).collect()
    assert len(got) == len(rows) + len(ODD)
    assert all(r.predicted == 1 for r in got if r.doc_id is not None and 100 <= r.doc_id < 140)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.filter("doc_id >= 100 and doc_id < 140").count() == 0
    none = toxicity.toxicity_report(docs, labels.limit(0)).collect()
    assert {r.predicted for r in none} == {0}


def test_grams_stay_inside_texts():
    codes, owner = toxicity.prepared(["ab", "", "abcd"])
    found = defaultdict(set)
    for hashes, where in toxicity.grams(codes):
        for h, w in zip(hashes.tolist(), where.tolist(), strict=True):
            found[int(owner[w])].add(h)
    def count(text):
        return len({text[i:i + n] for n in toxicity.SIZES for i in range(len(text) - n + 1)})
    assert {k: len(v) for k, v in found.items()} == {0: count(" ab "), 2: count(" abcd ")}


def fill(sizes, weights):
    """Targets by sharing the excess again until no source is above its limit."""
    budget, limit = 1.5 * sum(sizes.values()), {s: 2 * n for s, n in sizes.items()}
    full = set()
    while True:
        free = [s for s in sizes if s not in full]
        level = (budget - sum(limit[s] for s in full)) / sum(weights[s] for s in free) if free else 0
        over = {s for s in free if level * weights[s] > limit[s]}
        if not over:
            return {s: limit[s] if s in full else level * weights[s] for s in sizes}
        full |= over


def test_mix(make):
    counts = {"a": 4000, "b": 50, "c": 700, "d": 20, "é": 300, None: 90}
    rows, i = [], 0
    for source, n in counts.items():
        for k in range(n):
            rows.append((i, "word " * (k % 13 + 1) + ("#!" * 20 if k % 2 else ""), source))
            i += 1
    docs = make(rows)
    got = mixing.mix_report(docs).collect()
    size = {i: len(t.split()) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    sizes = Counter()
    for i, s in source.items():
        sizes[s] += size[i]
    order = sorted((s for s in counts if s is not None)) + [None]
    want = fill(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[s]) and r.target == pytest.approx(want[s])
        whole = int(want[s] // sizes[s])
        assert r.taken in (whole * r.size, min(2, whole + 1) * r.size)
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 40 for s in counts)
    assert sorted(map(tuple, mixing.mix_report(docs.repartition(7)).collect())) == sorted(map(tuple, got))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert all(copies[r.doc_id] * r.size == r.taken for r in got)
    # in a source taken in part, clean documents are drawn more often than noisy ones
    part = [r for r in got if source[r.doc_id] == "a"]
    share = [sum(r.taken > min(x.taken for x in part) for r in part if (r.doc_id % 2 == 0) == clean) for clean in (True, False)]
    assert not len({r.taken // r.size for r in part}) == 2 or share[0] != share[1]


def test_mix_of_odd_rows(make):
    docs = make([(i, t, s) for (i, t), s in zip(ODD, ["x", None, "", "y"] * 4, strict=False)])
    got = mixing.mix_report(docs).collect()
    assert len(got) == len(ODD) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix_report(make([(1, None), (2, "")])).collect()[0].taken == 0


def test_perspectives(spark):
    turns = spark.createDataFrame([
        (1, 0, "system", "be kind", 0), (1, 1, "ann", "hi <|end|>", 0), (1, 2, "bob", "yo", 0), (1, 2, "bob", "yo", 0),
        (1, 70, "ann", None, 0), (2, None, None, "x", 0), (2, 0, "bob", "y", 0), (3, 0, "system", "alone", 0), (None, 0, "bob", "z", 0)],
        "conv_id long, turn int, role string, text string, part int")
    got = {(r.conv_id, r.speaker, r.part): r for r in chat.perspectives(turns).collect()}
    assert set(got) == {(1, "ann", 0), (1, "ann", 1), (1, "bob", 0), (1, "bob", 1), (2, "unknown", 0), (2, "unknown", -1),
                        (2, "bob", 0), (2, "bob", -1), (None, "bob", 0)}
    ann = got[1, "ann", 0]
    assert ann.dialogue == ("<|system|>\nbe kind<|end|>\n<|assistant|>\nhi < |end|><|end|>\n<|user bob|>\nyo<|end|>\n")
    low, high = map(int, ann.mask.split(":"))
    assert ann.dialogue[low:high] == "hi < |end|><|end|>\n" and ann.n_turns == 3 and ann.n_masked == 1
    bob = got[1, "bob", 0]
    low, high = map(int, bob.mask.split(":"))
    assert bob.dialogue[low:high] == "yo<|end|>\n" and "<|user ann|>" in bob.dialogue


def test_empty_tables(spark, make):
    none, labels = make([(1, "x")]).limit(0), spark.createDataFrame([], "doc_id long, toxic int")
    runs = [sanitise.span_report, sanitise.sanitise, spotsigs.edited_report, mixing.mix_report, mixing.mix,
            lambda d: pieces.encoded_digests(d, queries.piece_model()), lambda d: token_counts.token_counts(d, queries.piece_model()),
            lambda d: toxicity.toxicity_report(d, labels), lambda d: toxicity.drop_toxic(d, labels)]
    assert [run(none).collect() for run in runs] == [[]] * len(runs)
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat.perspectives(empty).collect() == []


def test_pipeline(spark, folder, documents):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "sentencepiece"]
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and all(r.ids == library.encode(r.text) for r in rows)
    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.staged(stage(spark, docs, folder), name)
        after = docs.collect()
        assert docs.columns == documents.columns and all(r == before[r.doc_id] for r in after)
        seen.append((before, Counter(r.doc_id for r in after)))
    model = toxicity.fit(documents, spark.read.parquet(f"{folder}/labels.parquet"))
    before, after = seen[0]
    scores = dict(zip(before, model.scores([r.text for r in before.values()]), strict=True))
    assert set(after) == {i for i, s in scores.items() if s < 0.5}
    before, after = seen[1]
    first = {}
    for i in sorted(before):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i].text), i)
    assert set(after) == set(first.values())
    before, after = seen[2]
    from llm.test_pairs import joined, shingles
    sets, ids = {i: shingles(r.text) for i, r in before.items()}, sorted(before)
    root = joined([(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
                   if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])], ids)
    least = {}
    for i in ids:
        least.setdefault(root[i], i)
    assert set(after) == set(least.values())
    before, after = seen[3]
    taken = {r.doc_id: r.taken // r.size if r.size else None
             for r in mixing.mix_report(spark.createDataFrame(list(before.values()), documents.schema)).collect()}
    assert all(after[i] == n for i, n in taken.items() if n is not None)
    assert Counter(r.doc_id for r in rows) == after


def test_pipeline_of_odd_rows(spark, make, tmp_path, folder):
    """Nulls, empty and blank texts, repeated rows and ties; whole documents come out encoded, and no rows from none."""
    from pyspark.sql import functions as F
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    toxic = spark.read.parquet(f"{folder}/documents.parquet")
    odd = make([(i if i is None else i + 10**6, text) for i, text in ODD], clashing=False)
    for name, docs in (("odd", toxic.unionByName(odd)), ("none", toxic.filter(F.lit(False)))):
        path = tmp_path / name
        docs.write.parquet(str(path / "documents.parquet"))
        labels.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").write.parquet(str(path / "labels.parquet"))
        rows = corpus_pipeline.run(spark, str(path)).collect()
        assert all(r.ids == library.encode(r.text or "") for r in rows)
        ids = {r.doc_id for r in rows}
        if name == "none":
            assert rows == []
        else:
            # equal but for white space: the least id stays
            assert {10**6 + 5, 10**6 + 6}.isdisjoint(ids) and ids <= {r.doc_id for r in docs.collect()}


def test_pipeline_decodes_what_it_encodes(spark, make, folder):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    rows = corpus_pipeline.encode_pieces(spark, make(ODD), folder)
    assert rows.columns == ["doc_id", "source", "text", "ids", "decoded"]
    rows = rows.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        ids = library.encode(r.text or "")
        assert r.ids == ids and r.decoded == library.decode(ids)
