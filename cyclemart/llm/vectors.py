"""Near-duplicate vectors by randomised-rotation binary codes.

Unit vectors are rotated at random into ``bits`` dimensions; a vector's code is the signs of what it becomes, stored
with its correction factor, the inner product of the vector and its code. For a vector ``q``, ``<code, q> / factor`` is an
unbiased estimate of the cosine, with an error bound that the factor gives. Pairs whose upper bound misses the
threshold are settled by the codes; the others are computed again in double precision.

Pairs to look at come from tables that hash fixed subsets of the code bits. Their number and size follow from the
number of vectors and the recall asked for at the threshold. Large buckets are dealt out as pairs of blocks, so no
pair in a bucket is left out and no task holds more than two blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.llm.common import components, materialise


#: More tables than any setting in use needs; their numbers fit the bits that keys have for them.
TABLE_BITS = 10
MOST_TABLES = 1 << TABLE_BITS


@dataclass(frozen=True)
class VectorSettings:
    """``recall`` is the least chance to find a pair exactly at the threshold; closer pairs are found more surely.
    ``confidence`` is the number of standard errors of the bound, ``block`` the rows of a block."""

    threshold: float = 0.9
    recall: float = 0.95
    bits: int = 256
    confidence: float = 4.0
    block: int = 1024
    seed: int = 5


def rotation(dims: int, s: VectorSettings) -> np.ndarray:
    """``dims`` orthonormal rows in ``bits`` dimensions (or ``dims``, if that is more)."""
    width = max(s.bits, dims)
    q, _ = np.linalg.qr(np.random.default_rng(s.seed).normal(size=(width, dims)))
    return q.T.copy()


def table_plan(rows: int, s: VectorSettings) -> tuple[int, int]:
    """Bits of a key and number of tables: keys of three bits more than the rows need, and as many tables as the recall needs.

    All tables draw from the same code, so they do not miss a pair independently. Of the ``bits`` of a pair at the threshold
    a binomial number agrees; given that number, tables draw independently, and the recall is the mean over it.
    """
    agree = 1 - math.acos(min(1.0, s.threshold)) / math.pi
    width = min(24, max(8, math.ceil(math.log2(max(rows, 2))) + 3), s.bits)
    same = np.arange(s.bits + 1)
    choose = np.array([math.lgamma(s.bits + 1) - math.lgamma(k + 1) - math.lgamma(s.bits - k + 1) for k in same])
    weight = np.exp(choose + same * math.log(agree) + (s.bits - same) * math.log1p(-agree)) if agree < 1 else (same == s.bits).astype(float)
    k = np.arange(width)
    hit = np.where(same >= width, np.prod(np.maximum(same[:, None] - k, 0) / (s.bits - k), axis=1), 0.0)
    tables = 1
    while tables < MOST_TABLES and weight @ (1 - (1 - hit) ** tables) < s.recall:
        tables += 1
    return width, tables


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, their signs and correction factors."""
    rotated = vectors @ turn
    signs = rotated >= 0
    return rotated, signs, np.abs(rotated).sum(axis=1) / math.sqrt(turn.shape[1])


def unit(v: np.ndarray) -> np.ndarray:
    """Rows at unit length; scaled first, so that neither large nor small numbers leave the range."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _pairs(size: np.ndarray, start: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of the same bucket, in pieces: rows ``d`` apart for each ``d``."""
    place = np.arange(size.sum()) - np.repeat(start, size)
    room = np.repeat(size, size) - place
    i_parts, j_parts, held = [], [], 0
    for d in range(1, int(size.max())):
        i = np.flatnonzero(room > d)
        i_parts.append(i)
        j_parts.append(i + d)
        held += len(i)
        if held > limit:
            yield np.concatenate(i_parts), np.concatenate(j_parts)
            i_parts, j_parts, held = [], [], 0
    if held:
        yield np.concatenate(i_parts), np.concatenate(j_parts)


def _links_of(key, low, high, block, v, n, key_bits, width, turn, s) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Links inside each bucket of sorted rows: the weight each row links with, and edges that join what links join.

    Of a pair of blocks only rows of different blocks are compared; a pair counts in the first table that
    brings it together.
    """
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
    size = np.diff(np.append(new, len(key)))
    rotated, signs, factor = encode(v, turn)
    rotated, code = rotated.astype(np.float32), np.where(signs, np.float32(1), np.float32(-1)) / np.float32(math.sqrt(turn.shape[1]))
    error = s.confidence * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / (turn.shape[1] - 1))
    links, root = np.zeros(len(key), dtype=np.int64), np.arange(len(key))
    for i, j in _pairs(size, new, 1 << 17):
        apart = (low[i] == high[i]) | (block[i] != block[j])
        i, j = i[apart], j[apart]
        guess = np.einsum("ij,ij->i", rotated[i], code[j]) / factor[j]
        maybe = guess + error[j] >= s.threshold
        i, j = i[maybe], j[maybe]
        linked = np.einsum("ij,ij->i", v[i], v[j]) >= s.threshold
        i, j = i[linked], j[linked]
        if not len(i):
            continue
        first, table = np.ones(len(i), dtype=bool), key[i] >> width & MOST_TABLES - 1
        for earlier in range(int(table.max())):
            ask = np.flatnonzero(first & (table > earlier))
            bits = key_bits[earlier]
            first[ask] = (signs[i[ask]][:, bits] != signs[j[ask]][:, bits]).any(axis=1)
        links += np.bincount(i[first], weights=n[j[first]], minlength=len(key)).astype(np.int64)
        links += np.bincount(j[first], weights=n[i[first]], minlength=len(key)).astype(np.int64)
        while True:  # smallest row reachable so far, by hooking and jumping
            ri, rj = root[i], root[j]
            if (ri == rj).all():
                break
            np.minimum.at(root, np.maximum(ri, rj), np.minimum(ri, rj))
            while (root[root] != root).any():
                root = root[root]
    moved = np.flatnonzero(root != np.arange(len(key)))
    return links, (moved, root[moved])


def near_duplicates(embeddings: DataFrame, s: VectorSettings = VectorSettings(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of one length link
    with each other only. An empty table gives an empty result, other columns are ignored. Equal vectors are one node with a weight and link with each other. Null ids never are a component
    unless they are alone. Every pair found at the threshold or above in double precision links, none below it.
    """
    spark = embeddings.sparkSession
    source = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    tagged = source.withColumn("fine", F.coalesce(fine, F.lit(False))).withColumn("node", F.when(F.col("fine"), F.xxhash64(F.transform("v", lambda x: x + 0.0))))
    nodes = materialise(tagged.where("fine").groupBy("node").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"), F.any_value("v").alias("v")), "vectors-nodes")
    # Lengths that only one vector has find no partner.
    lengths = nodes.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("rows")).where("rows > 1")
    width, tables = table_plan(lengths.agg(F.max("rows")).first()[0] or 0, s)
    codes: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}

    def code_of(dims: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rotation and key bits of the vectors of a length."""
        if dims not in codes:
            turn, rng = rotation(dims, s), np.random.default_rng(s.seed + 1)
            codes[dims] = turn, [np.sort(rng.choice(turn.shape[1], width, replace=False)) for _ in range(tables)]
        return codes[dims]

    kept_type = np.float32 if embeddings.schema[vector].dataType.simpleString() == "array<float>" else np.float64

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = 1 << np.arange(width, dtype=np.int64)
        for batch in batches:
            column = batch.column("v")
            sizes = np.diff(column.offsets.to_numpy())
            for dims in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dims)
                turn, key_bits = code_of(dims)
                v = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
                _, signs, _ = encode(unit(v), turn)
                # The length leads the key: vectors of different lengths never share a bucket.
                key = np.stack([((dims << TABLE_BITS | t) << width) + signs[:, bits] @ powers for t, bits in enumerate(key_bits)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").take(pa.array(rows)), batch.column("n").take(pa.array(rows)),
                     pa.array([x.astype(kept_type).tobytes() for x in v], pa.binary()), pa.array(list(key), pa.list_(pa.int64()))],
                    names=["node", "n", "v", "keys"])

    shared = nodes.join(lengths.select("dims"), F.size("v") == F.col("dims"), "left_semi")
    coded = shared.select("node", "n", "v").mapInArrow(keys, "node long, n long, v binary, keys array<long>")
    coded = materialise(coded, "vectors-codes")
    # Keys alone decide the buckets; vectors are sent only to buckets of two and more.
    hashed = coded.select("node", F.explode("keys").alias("key"))
    buckets = hashed.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key", F.ceil(F.col("rows") / s.block).cast("int").alias("blocks"))
    dealt = hashed.join(buckets, "key").withColumn("block", F.when(F.col("blocks") > 1, F.pmod("node", "blocks").cast("int")).otherwise(0))
    parts = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node")
    parts = parts.join(coded.select("node", "n", "v"), "node").select("key", "low", "high", "block", "node", "n", "v")
    parts = parts.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole buckets, some thousand rows at a time, in; degrees and joining edges out."""
        held: list[list] = [[] for _ in range(7)]

        def close(rows: int) -> Iterator[pa.RecordBatch]:
            columns = [np.array(held[k][:rows], dtype=np.int64) for k in range(6)]
            raw = held[6][:rows]
            for column in held:
                del column[:rows]
            sizes = columns[0] >> width + TABLE_BITS
            for dims in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dims)
                key, low, high, block, node, n = (c[at] for c in columns)
                v = unit(np.frombuffer(b"".join([raw[k] for k in at]), dtype=kept_type).astype(np.float64).reshape(len(at), dims))
                turn, key_bits = code_of(dims)
                links, (a, b) = _links_of(key, low, high, block, v, n, key_bits, width, turn, s)
                seen = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([node[seen], node[a]])), pa.array(np.concatenate([links[seen], np.zeros(len(a), dtype=np.int64)])),
                     pa.array(np.concatenate([node[seen], node[b]]), mask=np.concatenate([np.ones(len(seen), dtype=bool), np.zeros(len(b), dtype=bool)]))],
                    names=["node", "links", "other"])

        for batch in batches:
            for column, new in zip(held, batch.columns, strict=True):
                column.extend(new.to_pylist())
            if len(held[0]) > 4 * s.block:
                last = len(held[0]) - 1
                same = lambda k: all(held[c][k] == held[c][last] for c in range(3))
                while last and same(last - 1):
                    last -= 1
                if last:
                    yield from close(last)
        if held[0]:
            yield from close(len(held[0]))

    found = materialise(parts.mapInArrow(compare, "node long, links long, other long"), "vectors-links")
    of = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), "vectors-components")
    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = nodes.select("node", "first", "n").join(degrees, "node", "left").join(of, "node", "left").select(
        "node", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = placed.join(smallest, "component").select("node", "n_links", "component_id")
    result = tagged.select("vec_id", "node").join(classes, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.col("vec_id").eqNullSafe(component).alias("kept"))
