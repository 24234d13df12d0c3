"""SentencePiece encoding and decoding through a distinct-chunk table.

No piece of such a model crosses from an ordinary character to a whitespace marker, so a text falls
into chunks (markers and the word after them) that can be segmented apart. Every task keeps a table
of the distinct chunks it has met, segments each of them once, and joins the ids back to the texts by
position. The table lives in the task: exchanging every position of the corpus for a global table
would move several times the text itself. It is emptied once it holds more than ``TABLE_BYTES``, however long
its chunks are.

Null texts count as empty; an empty text has no ids and decodes to an empty text. Rows come back as
often as they come in.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from candlelake.llm.common import slices, worker_state

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
#: Memory of a table, and what an entry takes besides its chunk and its ids.
TABLE_BYTES, ENTRY_BYTES = 16 << 20, 120
#: Text a task works on at a time: its chunks, codes and ids take some forty times as much.
BLOCK_BYTES = 1 << 19


class ChunkTable:
    """Ids of distinct chunks, kept flat: chunk -> code, and each code's slice of the ids."""

    def __init__(self, model: str, limit: int = TABLE_BYTES):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("pieces of this model cross whitespace markers")
        if self.processor.normalize(" a  éﬁ ") != f"{MARK * 2}a{MARK * 2}éﬁ{MARK}":
            raise ValueError("this model normalises texts; chunks need a dummy prefix and nothing else")
        self.marker = self.processor.piece_to_id(MARK)
        if self.processor.is_unknown(self.marker):
            raise ValueError("this model has no piece for a whitespace marker")
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.held = 0
        self.flat = np.empty(1024, np.int32)
        self.first = np.zeros(1025, np.int64)

    def learn(self, chunks: list[str]) -> None:
        """Segments chunks not met before. The library puts the first marker back itself, but for no text."""
        new = [chunk for chunk in dict.fromkeys(chunks) if chunk not in self.codes]
        if not new:
            return
        found = self.processor.encode([chunk[1:] for chunk in new], num_threads=1)
        found = [ids or [self.marker] for ids in found]
        low, used = len(self.codes), int(self.first[len(self.codes)])
        ends = used + np.cumsum([len(ids) for ids in found])
        while ends[-1] > self.flat.size:
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while low + len(new) >= self.first.size:
            self.first = np.concatenate([self.first, np.empty_like(self.first)])
        self.flat[used:ends[-1]] = [i for ids in found for i in ids]
        self.first[low + 1:low + 1 + len(new)] = ends
        self.held += sum(map(sys.getsizeof, new)) + ENTRY_BYTES * len(new) + 4 * int(ends[-1] - used)
        self.codes.update(zip(new, range(low, low + len(new)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where each text's ids start (one more entry at the end)."""
        if self.held > self.limit:
            self.clear()
        split = [CHUNK.findall(MARK + text.replace(" ", MARK)) if text else [] for text in texts]
        chunks = [chunk for part in split for chunk in part]
        self.learn(chunks)
        codes = np.fromiter(map(self.codes.__getitem__, chunks), np.int64, len(chunks))
        start, length = self.first[codes], np.diff(self.first)[codes]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        where = np.repeat(start - (ends - length), length) + np.arange(total)
        bounds = np.concatenate([[0], ends])[np.cumsum([0, *map(len, split)])]
        return self.flat[where], bounds

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        every = ids.tolist()
        lists = [every[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return self.processor.decode(lists, num_threads=1) if lists else []


def chunk_table(model: str) -> ChunkTable:
    kept = worker_state()
    if ("chunks", model) not in kept:
        kept["chunks", model] = ChunkTable(model)
    return kept["chunks", model]


def encoder(model: str, decode: bool, at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function from ``row`` to ``row, ids, decoded``; field ``at`` of a row is its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = chunk_table(model)
        rows = (batch.column("row") for batch in batches)
        read = (pa.RecordBatch.from_arrays([row, row.field(at)], ["row", "text"]) for row in rows)
        for batch in slices(read, limit=BLOCK_BYTES):
            ids, bounds = pieces.encode([text or "" for text in batch.column("text").to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            texts = pa.array(pieces.decode(ids, bounds) if decode else [None] * batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists, texts], ["row", "ids", "decoded"])

    return run


def encode_texts(docs: DataFrame, model: str, decode: bool = True) -> DataFrame:
    """``(row, ids, decoded)``: the input row as a struct, its ids, and the text they decode to.

    ``row`` keeps every column of ``docs``, whatever the names; only ``text`` is read, and it travels once.
    """
    names = docs.columns
    at = names.index("text") if "text" in names else [name.lower() for name in names].index("text")
    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(encoder(model, decode, at), StructType([
        rows.schema["row"], StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())]))


def encoded_digests(docs: DataFrame, model: str) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the decoded text."""
    return encode_texts(docs.select("doc_id", "text"), model).select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
