"""Lexical retrieval packing: sequences of related documents, filled to the last token.

A document is its token ids and an end id. Whole windows of a long document are sequences of their own; the
rest, its tail, is packed. Tails form shards of fixed size, each with an inverted index scored by BM25 whose
document frequencies and mean length are counted over all tails. Taking tails in turn as seeds, the
index ranks the unused neighbours of the seed, and the window takes them in that order as long as they fit; the
best one that doesn't fit is cut to fill what is left, and its rest stays in the shard.

Tails are sorted over the whole table by their ids of highest BM25 weight before shards are cut, so that related tails of
any file meet; ids that many tails start with are told apart by the next ones. A shard is a run of rows of the
sorted table, so memory does not depend on keys, and a lost task gives the same shards again.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.llm.common import held, materialise

_STOPS = (".", ",")
_OTHER_BLANKS = re.compile(r"[^\S \n]")


@dataclass(frozen=True)
class PackingSettings:
    """``vocabulary`` and ``ranks`` are the files of one byte-level BPE, for the tokenizers and tiktoken libraries;
    ``shard`` is the number of tails of an index, ``route`` the number of ids tails are sorted by, ``k1`` and ``b`` are BM25's."""

    vocabulary: str
    ranks: str
    pattern: str
    window: int = 1024
    end_id: int = 0
    ids: int = 1 << 16
    shard: int = 256
    route: int = 3
    k1: float = 1.2
    b: float = 0.75


#: Longest piece whose ids are kept.
LONG = 64


class Encoder(dict):
    """Ids of texts as 16-bit numbers.

    A blank between two other characters always starts a new token, so what stands between such blanks is
    encoded on its own and remembered, up to ``limit`` pieces; so is a word before a full stop or comma. Texts with other white space are
    encoded whole, texts that name the special token by the tokenizers library itself.
    """

    def __init__(self, s: PackingSettings, limit: int = 800_000):
        super().__init__()
        import base64

        import tiktoken

        with open(s.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coding = tiktoken.Encoding("packing", pat_str=s.pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = coding.encode_ordinary
        self.vocabulary, self.limit, self.library = s.vocabulary, limit, None

    def __missing__(self, piece: str) -> bytes:
        if piece[-1:] in _STOPS and piece[1:-1].isalpha():
            value = self[piece[:-1]] + self[piece[-1]]
        else:
            value = array("H", self.whole(piece)).tobytes()
        if len(piece) <= LONG:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = value
        return value

    def ids(self, text: str) -> bytes:
        if "<|" in text:
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.vocabulary)
            return array("H", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or "\0" in text or _OTHER_BLANKS.search(text):
            return array("H", self.whole(text)).tobytes()
        return b"".join(map(self.__getitem__, text.replace(" ", "\0 ").split("\0")))


def _encoder(s: PackingSettings) -> Encoder:
    return held(("packing", s), lambda: Encoder(s))


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encode(docs: DataFrame, s: PackingSettings, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, doc_tokens, crcs, tail)``: checksums of the whole windows, and the ids after them. Null is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(s), s.end_id.to_bytes(2, sys.byteorder)
        for batch in batches:
            counts, crcs, tails = [], [], []
            for value in batch.column(1):
                ids = np.frombuffer(encoder.ids(value.as_py() or "") + end, dtype=np.uint16)
                whole = len(ids) // s.window * s.window
                counts.append(len(ids))
                crcs.append([_crc(ids[at:at + s.window]) for at in range(0, whole, s.window)])
                tails.append(ids[whole:].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(tails, pa.binary())],
                names=["doc_id", "doc_tokens", "crcs", "tail"])

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, doc_tokens long, crcs array<long>, tail binary")


def document_frequencies(encoded: DataFrame, s: PackingSettings) -> tuple[np.ndarray, int, int]:
    """Tails that hold each id, the number of tails that are not empty, and their length in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, tails, length = np.zeros(s.ids, dtype=np.int64), 0, 0
        for batch in batches:
            ids, of, sizes = _flat([v.as_py() for v in batch.column(0)])
            keys = np.unique(of.astype(np.int64) * s.ids + ids)
            counts += np.bincount(keys % s.ids, minlength=s.ids)
            tails, length = tails + int(np.count_nonzero(sizes)), length + int(sizes.sum())
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, [-1, -2]), pa.int32()), pa.array(np.append(counts[seen], [tails, length]), pa.int64())], names=["id", "n"])

    rows = encoded.select("tail").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    frequency, totals = np.zeros(s.ids, dtype=np.int64), {-1: 0, -2: 0}
    for row in rows:  # one for each id of the vocabulary at most
        if row.id < 0:
            totals[row.id] = row.n
        else:
            frequency[row.id] = row.n
    return frequency, totals[-1], totals[-2]


def _flat(tails: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(t) // 2 for t in tails], dtype=np.int64)
    return np.frombuffer(b"".join(tails), dtype=np.uint16).astype(np.int64), np.repeat(np.arange(len(tails)), sizes), sizes


def routes(tails: list[bytes], idf: np.ndarray, mean_length: float, s: PackingSettings) -> np.ndarray:
    """The ``route`` ids of highest BM25 weight of each tail, best first, -1 where it has no more."""
    ids, of, sizes = _flat(tails)
    keys, times = np.unique(of * s.ids + ids, return_counts=True)
    doc, token = keys // s.ids, keys % s.ids
    useful = idf[token] > 0
    doc, token, times = doc[useful], token[useful], times[useful]
    weight = idf[token] * times * (s.k1 + 1) / (times + s.k1 * (1 - s.b + s.b * sizes[doc] / max(mean_length, 1)))
    order = np.lexsort((token, -weight, doc))
    doc, token = doc[order], token[order]
    rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
    found = np.full((len(tails), s.route), -1, dtype=np.int64)
    first = rank < s.route
    found[doc[first], rank[first]] = token[first]
    return found


def by_content(encoded: DataFrame, idf: np.ndarray, mean_length: float, frequency: np.ndarray, s: PackingSettings) -> DataFrame:
    """``encoded`` sorted by routes over all partitions. Ids of a single tail lead nowhere and are no routes."""
    shared = encoded.sparkSession.sparkContext.broadcast((np.where(frequency > 1, idf, 0).astype(np.float32), mean_length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 1000):
                batch = whole.slice(low, 1000)
                found = routes([v.as_py() for v in batch.column(3)], *shared.value, s)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int32()) for c in found.T)], names=[*batch.schema.names, *names])

    names = [f"route_{k}" for k in range(s.route)]
    kind = encoded.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, doc_tokens long, crcs array<long>, tail binary, " + ", ".join(f"{n} int" for n in names)
    # Written first: the bounds of the ranges are drawn from the rows, which would compute the routes twice.
    routed = materialise(encoded.mapInArrow(run, schema).withColumn("copy", F.xxhash64("tail", "doc_id")), "packing-routed")
    return routed.repartitionByRange(*names, "copy").sortWithinPartitions(*names, "copy").select(*encoded.columns)


class ShardIndex:
    """Inverted index of the tails of one shard. Ids in over half of all tails weigh nothing and have no postings."""

    def __init__(self, tails: list[bytes], idf: np.ndarray, mean_length: float, s: PackingSettings):
        ids, of, self.sizes = _flat(tails)
        self.n = len(tails)
        keys, times = np.unique(ids * self.n + of, return_counts=True)
        token, doc = keys // self.n, keys % self.n
        useful = idf[token] > 0
        token, doc, times = token[useful], doc[useful], times[useful]
        norm = s.k1 * (1 - s.b + s.b * self.sizes[doc] / max(mean_length, 1))
        self.weight = idf[token] * times * (s.k1 + 1) / (times + norm)
        self.doc = doc
        _, first, self.slot, length = np.unique(token, return_index=True, return_inverse=True, return_counts=True)
        self.first, self.length = first, length
        order = np.argsort(doc, kind="stable")
        self.by_doc = self.slot[order]
        self.bounds = np.searchsorted(doc[order], np.arange(self.n + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every tail for the distinct ids of the seed."""
        slots = self.by_doc[self.bounds[seed]:self.bounds[seed + 1]]
        length = self.length[slots]
        slots, length = slots[length > 1], length[length > 1]
        if not len(slots):
            return np.zeros(self.n)
        stop = np.cumsum(length)
        at = np.arange(stop[-1]) + np.repeat(self.first[slots] - (stop - length), length)
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def pack_shard(tails: list[bytes], index: ShardIndex, window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of ``(tail, from, length)``. Ties of the ranking go to the earlier tail; empty tails are left out."""
    begin, left = [0] * index.n, index.sizes.tolist()
    windows = []
    for seed in range(index.n):
        while left[seed]:
            take = min(left[seed], window)
            content, space = [(seed, begin[seed], take)], window - take
            begin[seed] += take
            left[seed] -= take
            too_long = None
            if space:
                for k in np.argsort(-index.scores(seed), kind="stable").tolist():
                    if not left[k]:
                        continue
                    if left[k] <= space:
                        content.append((k, begin[k], left[k]))
                        space -= left[k]
                        begin[k] += left[k]
                        left[k] = 0
                        if not space:
                            break
                    elif too_long is None:
                        too_long = k
                if space and too_long is not None:
                    content.append((too_long, begin[too_long], space))
                    begin[too_long] += space
                    left[too_long] -= space
            windows.append(content)
    return windows


def pack(docs: DataFrame, s: PackingSettings, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every id of every document lies in exactly one piece; offsets have no gaps. Null and empty texts are
    their end id alone. Repeated rows and ids are packed row by row; other columns are ignored. An
    empty table gives no rows. Only the last window of a shard can need padding.
    """
    encoded = materialise(encode(docs, s, text, doc_id), "packing-encoded")
    frequency, tails, length = document_frequencies(encoded, s)
    idf = np.maximum(0, np.log((tails - frequency + 0.5) / (frequency + 0.5))).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((idf, length / max(tails, 1)))  # one number for each id
    ordered = by_content(encoded, idf, length / max(tails, 1), frequency, s)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean_length = shared.value
        sequence = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, counts, crcs, all_tails = (batch.column(i) for i in range(4))
            ids = ids.to_pylist()
            counts, crcs, all_tails = counts.to_pylist(), crcs.to_pylist(), all_tails.to_pylist()
            rows: list[tuple] = []
            for low in range(0, len(ids), s.shard):
                group = range(low, min(low + s.shard, len(ids)))
                tails = all_tails[group.start:group.stop]
                for i in group:
                    for k, crc in enumerate(crcs[i]):
                        rows.append((ids[i], k * s.window, s.window, crc, counts[i], sequence, 0))
                        sequence += 1
                for content in pack_shard(tails, ShardIndex(tails, idf, mean_length, s), s.window):
                    offset = 0
                    for k, at, size in content:
                        i = low + k
                        crc = _crc(np.frombuffer(tails[k], dtype=np.uint16, count=size, offset=2 * at))
                        rows.append((ids[i], len(crcs[i]) * s.window + at, size, crc, counts[i], sequence, offset))
                        offset += size
                    sequence += 1
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type)] + [pa.array(c, pa.int64()) for c in columns[1:]], names=names)

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
