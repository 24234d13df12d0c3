"""Byte-level BPE against the library and against merging by rank."""

from __future__ import annotations

import hashlib
import random
from array import array

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import ODD

from candlelake.llm import byte_bpe, queries

FILE = public_tokenizers.path(queries.BYTE_RANKS)


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.byte_bpe(FILE, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(FILE),
                             special_tokens={})


def merged(ranks, piece):
    """The ids of a piece by definition: the pair of lowest rank, the leftmost of them, merges first."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[part] for part in parts]
        at = min(pairs)[1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    packed = np.array(ids, "<u4").tobytes()
    return len(ids), *(hashlib.sha256(x).hexdigest() for x in (packed, library.decode_bytes(ids)))


def test_query_equals_the_library(documents, texts, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in byte_bpe.encoded_digests(documents, FILE, public_tokenizers.PATTERN).collect()}
    assert got == {i: digests(library, text) for i, text in texts.items()}


def test_odd_rows(make, library):
    rows = [*ODD, (20, "<|endoftext|> don't I'LL we've 12345 ½²Ⅷ"), (21, "  \n\n  　x  \x1c\x85y"),
            (22, "日本語" * 3000), (23, "ab" * 40_000), (24, "🙂" * 5000), (25, "﻿​́é")]
    df = byte_bpe.encoded_digests(make(rows), FILE, public_tokenizers.PATTERN)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect()), key=repr)
    assert got == sorted(((i, *digests(library, text)) for i, text in rows), key=repr)
    assert byte_bpe.encoded_digests(make([(1, "a")]).filter("doc_id = 0"), FILE, public_tokenizers.PATTERN).collect() == []


def test_rows_keep_their_columns(make, library):
    row = byte_bpe.encode_texts(make([(1, "Hello  wörld", "news")]), FILE, public_tokenizers.PATTERN).head()
    ids = library.encode_ordinary("Hello  wörld")
    assert (row.ids, row.packed, row.decoded) == (ids, np.array(ids, "<u4").tobytes(), "Hello  wörld".encode())
    assert (row.row.source, row.row.ids, row.row.text) == ("news", 7, "Hello  wörld")
    assert byte_bpe.decode_ids(ids, FILE, public_tokenizers.PATTERN) == "Hello  wörld".encode()


def test_every_character_in_its_class(bpe, library):
    """Letters, numbers and white space are told apart for all code points as in the library."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(points), 4096):
        part = points[low:low + 4096]
        for text in (" ".join(f"a{c}1{c}" for c in part), "\n".join(f"{c}{c}!  {c}x" for c in part)):
            if list(bpe.encode(text)) != library.encode_ordinary(text):
                wrong = [hex(ord(c)) for c in part
                         if any(list(bpe.encode(t)) != library.encode_ordinary(t)
                                for t in (f" a{c}1{c} a", f"\n{c}{c}!  {c}x\n"))]
                raise AssertionError(wrong)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "the", "ing", " ", "er", "é", "日", "1", "\n", "zz", "'s", "in"]),
                max_size=60))
def test_any_text(parts):
    bpe = byte_bpe.byte_bpe(FILE, public_tokenizers.PATTERN)
    text = "".join(parts)
    for piece in (text, text.replace(" ", "")):
        if piece:
            assert list(bpe.merges.encode(piece.encode())) == merged(bpe.merges.ranks, piece.encode())
    assert bpe.decode(bpe.encode(text)) == text.encode()


def grown(seed, merges=60):
    """A vocabulary of the bytes and random merges of earlier tokens, so that many borders are contested."""
    draw = random.Random(seed)
    ranks = {bytes([b]): b for b in range(256)}
    pool = [b"a", b"b"] if seed % 2 else [b"a", b"b", b"c"]
    for _ in range(merges):
        token = draw.choice(pool) + draw.choice(pool)
        # only what merging reaches from lower ranks
        if token not in ranks and len(merged(ranks, token)) == 2:
            ranks[token] = len(ranks)
            pool.append(token)
    return ranks


@pytest.mark.parametrize("seed", range(20))
def test_contested_merges(seed):
    ranks = grown(seed)
    merges, draw = byte_bpe.Merges(ranks), random.Random(-seed)
    for _ in range(60):
        piece = bytes(draw.choice(b"aab" if seed % 2 else b"abc") for _ in range(draw.randint(1, 60)))
        assert list(merges.encode(piece)) == merged(ranks, piece), piece


def test_vocabularies_that_are_refused():
    ranks = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError, match="no merge"):
        byte_bpe.Merges({**ranks, b"abc": 256})
    with pytest.raises(ValueError, match="every byte"):
        byte_bpe.Merges({b"a": 0})


def test_piece_table_is_bounded_by_its_bytes(bpe):
    table = byte_bpe.PieceIds(bpe.merges, limit=2000)
    words = [f" word{i}" for i in range(200)] + ["x" * 5000]
    assert [list(table[word]) for word in words] == [merged(bpe.merges.ranks, word.encode()) for word in words]
    assert 0 < len(table) < 20 and table.held <= 2000


def test_linear_time(bpe):
    """Long runs of one letter and of letters without spaces: each place fails at most once."""
    for text in (b"a" * 200_000, b"abcab" * 40_000):
        assert bpe.decode(bpe.merges.encode(text)) == text
    assert isinstance(bpe.merges.encode(b"zzzz"), array)
