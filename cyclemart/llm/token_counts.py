"""Word-piece counts by a linear longest-match automaton.

Greedy tokenisation takes the longest piece of the vocabulary that starts at the current character, again and again.
The automaton is the vocabulary's trie with a failure link at every node: where no edge fits the next character, the
link leads to the node that is left once the longest pieces of what has been read are taken off, and a
number stored with it says how many pieces those are. One pass over the characters gives the count; no piece
is ever built.
"""

from __future__ import annotations

import re
from array import array
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.llm.common import held, map_columns

#: A word starts with this mark in the vocabulary, as in sentencepiece models.
WORD_START = "▁"


class LongestMatch:
    """Counts greedy pieces of a word. A character that no piece covers costs its UTF-8 bytes, as byte pieces would."""

    def __init__(self, pieces: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}]
        depth, token = array("l", [0]), bytearray(1)
        for piece in pieces:
            node = 0
            for c in piece:
                nxt = self.edges[node].get(c)
                if nxt is None:
                    nxt = len(self.edges)
                    self.edges[node][c] = nxt
                    self.edges.append({})
                    depth.append(depth[node] + 1)
                    token.append(0)
                node = nxt
            if node:
                token[node] = 1
        # The link of a node and the cost of the pieces taken off on the way to it.
        self.link, self.popped = array("l", [0]) * len(self.edges), array("l", [0]) * len(self.edges)
        queue: deque[tuple[int, str]] = deque()
        for c, node in self.edges[0].items():
            # A single character without a piece of its own counts as its bytes.
            self.link[node], self.popped[node] = 0, 1 if token[node] else len(c.encode("utf-8", "surrogatepass"))
            queue.append((node, c))
        while queue:
            node, _ = queue.popleft()
            for c, child in self.edges[node].items():
                if token[child]:
                    self.link[child], self.popped[child] = 0, 1
                else:
                    at, cost = self.link[node], self.popped[node]
                    while at and c not in self.edges[at]:
                        cost += self.popped[at]
                        at = self.link[at]
                    nxt = self.edges[at].get(c)
                    if nxt is None:  # only at the root: the character is in no piece's beginning
                        cost += len(c.encode("utf-8", "surrogatepass"))
                        nxt = 0
                    self.link[child], self.popped[child] = nxt, cost
                queue.append((child, c))

    def count(self, word: str) -> int:
        """Pieces of a word."""
        edges, link, popped = self.edges, self.link, self.popped
        node = total = 0
        for c in word:
            while True:
                nxt = edges[node].get(c)
                if nxt is not None:
                    node = nxt
                    break
                if not node:
                    total += len(c.encode("utf-8", "surrogatepass"))
                    break
                total += popped[node]
                node = link[node]
        while node:
            total += popped[node]
            node = link[node]
        return total


#: Longest word whose count is kept.
LONG = 64


class _Counts(dict):
    """Counts of words met before; starts anew when full. Words of more than ``LONG`` characters are not kept."""

    def __init__(self, path: str, limit: int = 500_000):
        super().__init__()
        self.automaton, self.limit = LongestMatch(vocabulary(path)), limit

    def __missing__(self, word: str) -> int:
        value = self.automaton.count(WORD_START + word)
        if len(word) <= LONG:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value


_RESERVED = re.compile(r"<(unk|s|/s|0x[0-9A-F]{2})>")


def vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece model, without its reserved ones."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [p for p in (model.id_to_piece(i) for i in range(model.get_piece_size())) if not _RESERVED.fullmatch(p)]


def token_counts(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, the blank-separated words of the whole text, and ``n_tokens``, their greedy pieces.

    ``path`` names the vocabulary, a file of the same place on every machine. Null and empty texts
    have 0 of both. Repeated rows count each; columns of the two names are replaced.
    """

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        counts = held(("token counts", path), lambda: _Counts(path))
        words = [(v.as_py() or "").split() for v in batch.column(text)]
        return {"n_words": pa.array([len(w) for w in words], pa.int64()),
                "n_tokens": pa.array([sum(map(counts.__getitem__, w)) for w in words], pa.int64())}

    source = docs.withColumn(text, F.col(text).cast("string"))
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return map_columns(source, compute, fields, docs.columns if keep is None else keep)
