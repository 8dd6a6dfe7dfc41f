"""Near-duplicates by SimHash and covering locality-sensitive hashing.

A covering family of ``2 ** (radius + 1) - 1`` bit masks hashes the fingerprints: every bit position has a
binary label of ``radius + 1`` bits, and mask ``v`` holds the positions whose label has an odd product with
``v``. Any ``radius`` positions leave some mask untouched, so two fingerprints within the radius agree under
at least one of the masks: no pair is missed.

Equal fingerprints are one node. Fingerprints that agree under a mask form a bucket. Small buckets are
compared inside one task; those with more members than ``bucket`` are hashed again, by masks over other labels,
with the bucket's own key in front. Each level fixes about half of the bits still free, so a
bucket of the third level has few members by construction, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.llm.common import components, map_columns, materialise

BITS = 64
RADIUS = 3
SHINGLE = 3
BUCKET = 512
SEED = 42


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        hashes = np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)
    else:
        parts = zip(*(words[i:] for i in range(size)), strict=False)
        hashes = np.array([digest(b" ".join(p), SEED) for p in parts], dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        block = hashes[at:at + 65536]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint as a signed long. Null and wordless texts have 0."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        values = np.array([fingerprint(v.as_py()) for v in batch.column(text)], dtype=np.uint64)
        return {"fp": pa.array(values.view(np.int64), pa.int64())}

    return map_columns(docs, compute, [T.StructField("fp", T.LongType())], docs.columns if keep is None else keep)


def covering_masks(radius: int = RADIUS, level: int = 0) -> list[int]:
    """The masks of one level, as signed longs. Labels are drawn from the level number, evenly over all values."""
    size = radius + 1
    rng = np.random.default_rng(1000 + level)
    labels = rng.permutation(np.arange(BITS) % (1 << size))
    masks = []
    for v in range(1, 1 << size):
        mask = sum(1 << bit for bit in range(BITS) if bin(int(labels[bit]) & v).count("1") % 2)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def _bucket_edges(rows: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that join the fingerprints of one bucket as their links within the radius do."""
    n = len(rows)
    if n == 2:
        a, b = int(rows[0]), int(rows[1])
        return [(a, b)] if (a ^ b).bit_count() <= radius else []
    near = np.bitwise_count(rows[:, None] ^ rows[None, :]) <= radius
    edges, left = [], np.ones(n, dtype=bool)
    for start in range(n):
        if not left[start]:
            continue
        left[start] = False
        front = [start]
        while front:
            at = front.pop()
            new = np.flatnonzero(near[at] & left)
            left[new] = False
            edges += [(int(rows[at]), int(rows[k])) for k in new]
            front += new.tolist()
    return edges


def _within(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows of whole buckets in, joining edges out."""
        held_key, held = None, []
        out: list[tuple[int, int]] = []

        def close():
            if len(held) > 1:
                out.extend(_bucket_edges(np.array(held, dtype=np.int64).view(np.uint64), radius))

        def emit():
            pairs = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            for key, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != held_key:
                    close()
                    held_key, held = key, []
                held.append(fp)
            if len(out) > 100_000:
                yield emit()
        close()
        yield emit()

    return run


def links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(a, b)`` that connect distinct fingerprints ``fp`` exactly as all links within the radius do.

    ``nodes`` must hold each fingerprint once. Inside a bucket a spanning forest stands for the links.
    """
    found = None
    rest = nodes.select("fp", F.lit(0).cast("long").alias("key"))
    for level in range(3):
        masks = covering_masks(radius, level)
        keys = F.array(*[F.struct(F.xxhash64("key", F.lit(level * 100 + t), F.col("fp").bitwiseAND(F.lit(m))).alias("key")) for t, m in enumerate(masks)])
        keyed = rest.select("fp", F.explode(keys).alias("k")).select(F.col("k.key").alias("key"), "fp")
        if level:
            keyed = keyed.distinct()
        sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        last = level == 2
        large = None if last else materialise(sizes.where(F.col("n") > bucket), f"simhash-large-{level}")
        small = keyed if last else keyed.join(large, "key", "left_anti")
        inside = small.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_within(radius), "a long, b long")
        found = inside if found is None else found.unionByName(inside)
        if last or large.isEmpty():
            break
        rest = keyed.join(large, "key", "left_semi").select("fp", "key")
    return found


def _placed(nodes: DataFrame, radius: int, bucket: int) -> DataFrame:
    """``nodes`` with ``component``, the smallest fingerprint reachable by links within the radius."""
    of = components(links(nodes, radius, bucket), "simhash-components")
    return nodes.join(of, nodes.fp == of.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))


def survivors(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, text_hash)`` of one row per component: that of the smallest id, nulls last, then of the smallest hash of its
    text. Rows are told apart by both, so null or repeated ids don't join rows whose texts differ."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    prints = fingerprints(source.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), "text", ["doc_id", "text_hash"])
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = materialise(prints.groupBy("fp").agg(F.min(row).alias("first")), "simhash-nodes")
    return _placed(nodes, radius, bucket).groupBy("component").agg(F.min("first").alias("first")).select("first.doc_id", "first.text_hash")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``: ``component_id`` is the smallest id reachable by
    fingerprints that differ in at most ``radius`` bits, its own included.

    Null, empty and wordless texts share fingerprint 0, which links like any other. Rows with equal
    ids stay apart rows of one document each; a null id never becomes a component unless all ids of
    the component are null. Other columns are ignored.
    """
    prints = materialise(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), "text", ["doc_id"]), "simhash-prints")
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    placed = _placed(nodes, radius, bucket)
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = placed.join(smallest, "component").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")
