"""Byte-level BPE by backtracking from longest matches.

The merges of a piece of text are found without merging: of all ways to cover it with tokens exactly one has
only neighbours that the merges would leave apart. An automaton over the vocabulary (bytes as Latin-1
characters) gives the longest token at every place; from the left the longest token is taken that fits its
neighbour, else the next shorter one, else the neighbour is taken back. A place that failed once is closed,
so a piece takes time in proportion to its length.

Two tokens fit if no merge crosses between them. Every token came about at the time of its rank from two
others (bytes are there from the start; of equal merges the left one goes first). Undoing the later of the
two neighbours step by step visits all pairs that ever met at the border; a merge of such a pair counts if
it comes before the merges that used up either side. The answers are memoised by pair.

Pieces are the matches of a pattern, encoded separately; every task keeps a table of the distinct pieces it
met, bounded by its bytes. Ranks must be those of merges: every token of two bytes or more splits into two
of lower rank, else the vocabulary is refused.

A null text counts as empty; an empty text has no ids and decodes to no bytes. Bytes that are no UTF-8 are
read as replacement characters. Rows come back as often as they come in, whatever columns they have; texts
of any length stream piece by piece.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from candlelake.llm.common import slices, utf8, worker_state

LATER = 1 << 62
MEMO_PAIRS = 1 << 20
TABLE_BYTES = 48 << 20
ENTRY_BYTES = 160


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens by their bytes, from lines of base64 text and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """Encodes pieces under the ranks of a byte-level vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        if any(bytes([byte]) not in ranks for byte in range(256)) or len(set(ranks.values())) != len(ranks):
            raise ValueError("the vocabulary needs every byte and distinct ranks")
        self.ranks, self.size = ranks, size
        self.token = [b""] * size
        self.length, self.shorter, self.born = [0] * size, [-1] * size, [-1] * size
        self.left, self.right = [-1] * size, [-1] * size
        self.joined: dict[tuple[int, int], int] = {}
        self.memo: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in sorted(ranks.items(), key=itemgetter(1)):
            self.token[rank], self.length[rank] = token, len(token)
            self.automaton.add_word(token.decode("latin-1"), rank)
            if len(token) > 1:
                self._split(token, rank)
        self.automaton.make_automaton()
        for token, rank in ranks.items():
            heads = (ranks.get(token[:cut]) for cut in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((head for head in heads if head is not None), -1)

    def _split(self, token: bytes, rank: int) -> None:
        """Notes the two tokens whose merge makes this one; all lower ranks are known by now."""
        for cut in range(1, len(token)):
            left, right = self._below(token[:cut], rank), self._below(token[cut:], rank)
            if left is not None and right is not None and self._apart(left, right):
                self.left[rank], self.right[rank], self.born[rank] = left, right, rank
                self.joined[left, right] = rank
                return
        raise ValueError(f"no merge of lower ranks makes token {rank}")

    def _below(self, part: bytes, rank: int) -> int | None:
        """The token of a part if it is a byte or of lower rank."""
        token = self.ranks.get(part, rank)
        return token if len(part) == 1 or token < rank else None

    def _apart(self, left: int, right: int) -> bool:
        """Whether the merges known so far leave a border between two neighbours."""
        left_used = right_used = LATER
        while True:
            merged = self.joined.get((left, right), LATER)
            if merged < left_used and merged <= right_used:
                return False
            if self.born[left] > self.born[right]:
                left_used, left = left, self.right[left]
            elif self.born[right] >= 0:
                right_used, right = right, self.left[right]
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        pair = left * self.size + right
        known = self.memo.get(pair)
        if known is None:
            if len(self.memo) >= MEMO_PAIRS:
                self.memo.clear()
            known = self.memo[pair] = self._apart(left, right)
        return known

    def encode(self, piece: bytes) -> array:
        """Ids of one piece, the same as merging its bytes by rank."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return array("I", (whole,))
        length, shorter, fits = self.length, self.shorter, self.fits
        longest = [-1] * len(piece)
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - length[token]] = token
        ids = array("I")
        closed = bytearray(len(piece) + 1)
        at, token = 0, longest[0] if piece else -1
        while at < len(piece):
            while token >= 0 and (closed[at + length[token]] or ids and not fits(ids[-1], token)):
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at += length[token]
                token = longest[at] if at < len(piece) else -1
            else:
                closed[at] = 1
                token = ids.pop()
                at -= length[token]
                token = shorter[token]
        return ids


class PieceIds(dict):
    """Ids of the distinct pieces met so far; emptied when it holds ``limit`` bytes."""

    def __init__(self, merges: Merges, limit: int = TABLE_BYTES):
        super().__init__()
        self.merges, self.limit, self.held = merges, limit, 0

    def __missing__(self, piece: str) -> array:
        ids = self.merges.encode(piece.encode())
        cost = ENTRY_BYTES + 4 * (len(piece) + len(ids))
        if cost <= self.limit:
            if self.held + cost > self.limit:
                self.clear()
                self.held = 0
            self.held += cost
            self[piece] = ids
        return ids


class ByteBpe:
    """Encodes and decodes whole texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, limit: int = TABLE_BYTES):
        self.merges = Merges(ranks)
        self.pieces = PieceIds(self.merges, limit)
        self.pattern = regex.compile(pattern)

    def encode(self, text: str) -> array:
        ids = array("I")
        found = map(itemgetter(0), self.pattern.finditer(text))
        ids.extend(chain.from_iterable(map(self.pieces.__getitem__, found)))
        return ids

    def decode(self, ids: array) -> bytes:
        return b"".join(map(self.merges.token.__getitem__, ids))


def byte_bpe(rank_file: str, pattern: str) -> ByteBpe:
    kept = worker_state()
    key = ("byte_bpe", rank_file, pattern)
    if key not in kept:
        kept[key] = ByteBpe(read_ranks(rank_file), pattern)
    return kept[key]


def little_endian(ids: array) -> bytes:
    """Ids as unsigned 32-bit integers, the layout of packed token files."""
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, decode: bool = True) -> DataFrame:
    """``(row, ids, packed, decoded)``: the input row as a struct, its ids, packed ids, and the bytes they decode to.

    ``row`` keeps every column of ``docs``, whatever the names; only ``text`` is read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(rank_file, pattern)
        for batch in slices(batches):
            every = [bpe.encode(text.decode("utf-8", "replace")) for text in utf8(batch.column("text"))]
            bounds = np.cumsum([0, *map(len, every)])
            flat = np.concatenate([np.frombuffer(ids, np.uint32) for ids in every]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))
            packed = pa.array(map(little_endian, every), pa.binary())
            texts = pa.array([bpe.decode(ids) if decode else None for ids in every], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), lists, packed, texts], ["row", "ids", "packed", "decoded"])

    rows = docs.select(F.struct("*").alias("row"), "text")
    return rows.mapInArrow(run, StructType([
        rows.schema["row"], StructField("ids", ArrayType(IntegerType())), StructField("packed", BinaryType()),
        StructField("decoded", BinaryType())]))


def decode_ids(ids: array | list[int], rank_file: str, pattern: str) -> bytes:
    return byte_bpe(rank_file, pattern).decode(ids)


def encoded_digests(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Per document the number of ids and digests of the packed ids and of the decoded bytes."""
    return encode_texts(docs.select("doc_id", "text"), rank_file, pattern).select(
        "row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
