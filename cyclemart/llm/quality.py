"""Quality scores: random-indexing word vectors pooled per document and a small calibrated network.

Words share a fixed number of buckets. Each bucket has a sparse ternary index vector, drawn from its
number; its word vector is the sum of the index vectors of its neighbours over the whole corpus. A
document is the weighted mean of its word vectors, over its words and over its distinct words, next to its
length and shares of repeated words. A two-layer network in numpy, fitted on a bounded sample of labels,
turns that into a probability, and a temperature fitted on rows it has not learned from calibrates it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.llm.common import held, held_out, map_columns

_UNIT = re.compile(r"[^\W_]+|[\W_]+")
_SIGNS = ".,;:!?#$%&*|\"')"


@dataclass(frozen=True)
class QualitySettings:
    """``sample`` bounds the labelled rows the network learns from; ``buckets * dims`` bounds the word vectors.
    The vectors themselves, and the word counts, are summed over every document."""

    buckets: int = 1 << 14
    dims: int = 48
    nonzeros: int = 4
    window: int = 2
    sample: int = 20_000
    hidden: int = 32
    epochs: int = 40
    threshold: float = 0.3
    seed: int = 7


#: Longest token whose units are kept.
LONG = 64


class _Units(dict):
    """Bucket numbers of a blank-separated token, as bytes: its word, a mark if the word is in capitals, and
    its runs of signs. Bounded: it starts anew when full, and keeps no token of more than ``LONG`` characters."""

    def __init__(self, buckets: int, limit: int = 500_000):
        super().__init__()
        self.mask, self.limit = buckets - 1, limit
        self.capitals = self._bucket("\x01capitals")

    def _bucket(self, unit: str) -> bytes:
        return (zlib.crc32(unit.encode("utf-8", "replace")) & self.mask).to_bytes(4, "little")

    def _word(self, word: str) -> bytes:
        marked = self.capitals if len(word) > 1 and word.isupper() else b""
        return self._bucket(word.lower()) + marked

    def __missing__(self, token: str) -> bytes:
        word = token.rstrip(_SIGNS)
        if word.isalpha():
            value = self._word(word) + (self._bucket(token[len(word):]) if len(word) < len(token) else b"")
        else:
            value = b"".join(self._word(u) if u[0].isalnum() else self._bucket(u) for u in _UNIT.findall(token))
        if len(token) <= LONG:
            if len(self) >= self.limit:
                self.clear()
            self[token] = value
        return value


def word_ids(text: str | None, buckets: int) -> np.ndarray:
    """Buckets of the words and signs of a text, in order; none for null."""
    units = held(("quality", buckets), lambda: _Units(buckets))
    return np.frombuffer(b"".join(map(units.__getitem__, (text or "").split())), dtype=np.uint32)


def index_vectors(s: QualitySettings) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the nonzero entries of every bucket's index vector."""
    rng = np.random.default_rng(s.seed)
    position = rng.integers(0, s.dims, (s.buckets, s.nonzeros))
    sign = rng.choice(np.array([-1.0, 1.0], dtype=np.float32), (s.buckets, s.nonzeros))
    return position, sign


def _accumulate(ids: np.ndarray, document: np.ndarray, s: QualitySettings, position, sign, total: np.ndarray) -> None:
    for offset in range(1, s.window + 1):
        together = document[offset:] == document[:-offset]
        left, right = ids[:-offset][together].astype(np.int64), ids[offset:][together].astype(np.int64)
        for here, there in ((left, right), (right, left)):
            for k in range(s.nonzeros):
                total += np.bincount(here * s.dims + position[there, k], weights=sign[there, k], minlength=total.size)


def word_vectors(docs: DataFrame, s: QualitySettings = QualitySettings(), text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Context vectors and counts of all buckets over every document.

    Each task sums its documents into one table of fixed size and sends the buckets it has seen;
    the sums meet by bucket. The result, ``buckets`` rows, is the only thing collected.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position, sign = index_vectors(s)
        total, counts = np.zeros(s.buckets * s.dims), np.zeros(s.buckets, dtype=np.int64)
        parts: list[np.ndarray] = []
        held = 0

        def flush():
            ids = np.concatenate(parts)
            document = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            counts[:] += np.bincount(ids, minlength=s.buckets)
            _accumulate(ids, document, s, position, sign, total)

        for batch in batches:
            for value in batch.column(0):
                ids = word_ids(value.as_py(), s.buckets)
                if len(ids):
                    parts.append(ids)
                    held += len(ids)
                if held > 2_000_000:
                    flush()
                    parts, held = [], 0
        if held:
            flush()
        seen = np.flatnonzero(counts)
        vectors = total.reshape(s.buckets, s.dims)[seen].astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64()), pa.array([v.tobytes() for v in vectors], pa.binary())],
            names=["bucket", "n", "vector"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for bucket, n, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(vector, dtype=np.float32).astype(np.float64)
                before = sums.get(bucket)
                sums[bucket] = (n, part) if before is None else (before[0] + n, before[1] + part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([n for n, _ in sums.values()], pa.int64()),
             pa.array([v.astype(np.float32).tobytes() for _, v in sums.values()], pa.binary())],
            names=["bucket", "n", "vector"])

    schema = "bucket int, n long, vector binary"
    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(partial, schema).repartition("bucket").mapInArrow(merge, schema).collect()
    vectors, counts = np.zeros((s.buckets, s.dims), dtype=np.float32), np.zeros(s.buckets, dtype=np.int64)
    for row in rows:
        vectors[row.bucket], counts[row.bucket] = np.frombuffer(row.vector, dtype=np.float32), row.n
    return vectors, counts


def pooling_table(vectors: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word vectors around their common mean, at unit length, and a weight that falls with a word's frequency."""
    total = max(int(counts.sum()), 1)
    share = counts / total
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)
    unit = unit - (share[:, None] * unit).sum(axis=0)
    return unit.astype(np.float32), (1e-2 / (1e-2 + share)).astype(np.float32)


def pooled(ids: np.ndarray, unit: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Features of one document: pooled over words, over distinct words, then log length, the shares of distinct
    words and of the commonest, and of words that repeat the last or the last but one."""
    dims = unit.shape[1]
    out = np.zeros(2 * dims + 5, dtype=np.float32)
    if len(ids):
        words, times = np.unique(ids, return_counts=True)
        w, v = weight[words], unit[words]
        each = w * times
        out[:dims] = each @ v / each.sum()
        out[dims:2 * dims] = w @ v / w.sum()
        again = [np.count_nonzero(ids[k:] == ids[:-k]) / len(ids) for k in (1, 2)]
        out[2 * dims:] = np.log1p(len(ids)) / 8, len(words) / len(ids), times.max() / len(ids), *again
    return out


@dataclass
class QualityModel:
    """A fitted scorer. Without labels of both kinds ``layers`` is None and every score is ``prior``."""

    settings: QualitySettings
    unit: np.ndarray
    weight: np.ndarray
    layers: tuple[np.ndarray, ...] | None
    temperature: float
    prior: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(features), self.prior)
        return 1 / (1 + np.exp(-np.clip(_logits(features, self.layers) / self.temperature, -30, 30)))


def _logits(x: np.ndarray, layers) -> np.ndarray:
    mean, scale, w1, b1, w2, b2 = layers
    return np.tanh((x - mean) / scale @ w1 + b1) @ w2 + b2


def fit_network(x: np.ndarray, y: np.ndarray, s: QualitySettings) -> tuple[tuple[np.ndarray, ...], float]:
    """Train by Adam on four fifths of the rows; fit the temperature on the rest."""
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(x))
    cut = max(1, len(x) // 5)
    rest, train = order[:cut], order[cut:] if len(x) > 4 else order
    mean, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
    z = (x - mean) / scale
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], s.hidden)), np.zeros(s.hidden),
              rng.normal(0, 1 / np.sqrt(s.hidden), s.hidden), np.zeros(())]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(s.epochs):
        shuffled = rng.permutation(train)
        for at in range(0, len(shuffled), 256):
            rows = shuffled[at:at + 256]
            hidden = np.tanh(z[rows] @ params[0] + params[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, params[2]) * (1 - hidden**2)
            grads = [z[rows].T @ back + 1e-4 * params[0], back.sum(axis=0), hidden.T @ error + 1e-4 * params[2], error.sum()]
            step += 1
            for i, grad in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                params[i] = params[i] - 3e-3 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    layers = (mean, scale, *params)
    logits = _logits(x[rest], layers)

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, np.where(y[rest] > 0.5, -1, 1) * logits / t)))

    return layers, min(np.geomspace(0.25, 8, 61), key=loss)


def featurise(docs: DataFrame, unit: np.ndarray, weight: np.ndarray, s: QualitySettings, text: str, keep: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((unit, weight))  # buckets * dims floats, whatever the corpus

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        u, w = shared.value
        return {"features": pa.array([pooled(word_ids(v.as_py(), s.buckets), u, w).tobytes() for v in batch.column(text)], pa.binary())}

    return map_columns(docs, compute, [T.StructField("features", T.BinaryType())], keep)


def fit(docs: DataFrame, labels: DataFrame, s: QualitySettings = QualitySettings(), text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> QualityModel:
    """Word vectors over all ``docs``; the network on at most ``s.sample`` labelled rows that are not held out.

    The sample is the labels of smallest hash of the id, so it is the same at every run. Null
    labels teach nothing; of repeated ids one row is taken.
    """
    unit, weight = pooling_table(*word_vectors(docs, s, text))
    chosen = (labels.where(F.col(label).isNotNull() & ~held_out(doc_id)).groupBy(F.col(doc_id).alias("_id"))
              .agg(F.max(F.col(label).cast("double")).alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(s.sample))
    known = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), "_id")
    rows = featurise(known, unit, weight, s, "text", ["_id", "_label"]).groupBy("_id").agg(
        F.max("_label").alias("y"), F.max("features").alias("x")).collect()
    rows.sort(key=lambda r: r._id)
    y = np.array([float(r.y > 0.5) for r in rows])
    prior = float(y.mean()) if len(y) else 0.5
    if len(set(y)) < 2:
        return QualityModel(s, unit, weight, None, 1.0, prior)
    layers, temperature = fit_network(np.array([np.frombuffer(r.x, dtype=np.float32) for r in rows], dtype=np.float64), y, s)
    return QualityModel(s, unit, weight, layers, float(temperature), prior)


def score(docs: DataFrame, model: QualityModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (score at least the threshold).

    Null and empty texts are scored like a document without words. Columns of these names are replaced.
    ``keep`` names the columns to carry, all by default. Every row is scored on its own whole text, so ties,
    repeated rows and empty tables need no care.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        m = shared.value
        features = np.array([pooled(word_ids(v.as_py(), m.settings.buckets), m.unit, m.weight) for v in batch.column(text)])
        scores = m.scores(features)
        return {"score": pa.array(scores, pa.float64()), "predicted": pa.array((scores >= m.settings.threshold).astype(np.int32), pa.int32())}

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return map_columns(docs, compute, fields, docs.columns if keep is None else keep)
