"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie. Its failure links say where matching goes on once the longest piece so far
is taken off, and each link holds the number of pieces taken off on the way, so that a word's greedy
longest-match length is a sum over links: every character is read once, no piece is built and nothing
is matched twice. Words are the runs between ASCII white space, with a marker in front, so that pieces
with the marker begin words and the others continue them. A word that the vocabulary cannot spell
counts as one unknown token.

Null texts count as empty. Rows come back as often as they come in.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from candlelake.llm.common import per_slice, utf8, worker_state

MARK = "▁"
#: Words a task keeps, and the longest one it keeps, in bytes; longer ones are matched again in every slice.
KNOWN_WORDS, LONGEST_KNOWN = 300_000, 64


class LongestMatch:
    """Trie with failure links; nodes are numbers, the root is 0, and -1 means no failure link."""

    def __init__(self, vocabulary: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        final = [False]
        for piece in filter(None, vocabulary):
            node = 0
            for char in piece:
                child = self.next[node].get(char)
                if child is None:
                    child = self.next[node][char] = len(self.next)
                    self.next.append({})
                    final.append(False)
                node = child
            final[node] = True
        self.fail = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for char, node in self.next[parent].items():
                queue.append(node)
                if final[node]:
                    self.fail[node], self.popped[node] = 0, 1
                    continue
                count, state = self.popped[parent], self.fail[parent]
                while state >= 0 and char not in self.next[state]:
                    count += self.popped[state]
                    state = self.fail[state]
                if state >= 0:
                    self.fail[node], self.popped[node] = self.next[state][char], count

    def count(self, word: str) -> int:
        """Pieces of the greedy longest match, 0 if the word cannot be spelt."""
        node = total = 0
        for char in word:
            while (child := self.next[node].get(char)) is None:
                if self.fail[node] < 0:
                    return 0
                total += self.popped[node]
                node = self.fail[node]
            node = child
        while node:
            if self.fail[node] < 0:
                return 0
            total += self.popped[node]
            node = self.fail[node]
        return total


def automaton(model: str) -> tuple[LongestMatch, dict[bytes, int]]:
    """The automaton over a piece model's ordinary pieces, and the words counted so far."""
    kept = worker_state()
    if ("pieces", model) not in kept:
        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        ordinary = (i for i in range(processor.get_piece_size())
                    if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i)))
        kept["pieces", model] = LongestMatch(map(processor.id_to_piece, ordinary)), {}
    return kept["pieces", model]


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` of every row; a word seen before is not matched again."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        matcher, known = automaton(model)
        if len(known) > KNOWN_WORDS:
            known.clear()
        split = [text.split() for text in utf8(batch.column("text"))]
        words = [word for part in split for word in part]
        new = set(words).difference(known)
        known.update((word, matcher.count(MARK + word.decode())) for word in new)
        counts = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        for word in new:
            if len(word) > LONGEST_KNOWN:
                del known[word]
        bounds = np.cumsum([0, *map(len, split)])
        tokens = np.diff(np.concatenate([[0], np.cumsum(np.maximum(counts, 1))])[bounds])
        unknown = np.diff(np.concatenate([[0], np.cumsum(counts == 0)])[bounds])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (np.diff(bounds), tokens, unknown))],
            ["doc_id", "n_words", "n_tokens", "n_unknown"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(per_slice(work), f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")
