"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.session import materialise, working_path

__all__ = ["components", "discard", "held", "held_out", "map_columns", "materialise", "table", "working_path"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def discard(spark: SparkSession, path: str) -> None:
    """Remove a working folder whose rows nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_HELD: dict = {}


def held(key: tuple, make: Callable[[], object]):
    """What a Python worker remembers from batch to batch. Workers serve one stage after the other, so only what the current
    operator needs is kept: asking for something else forgets the rest."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def held_out(doc_id: Column | str) -> Column:
    """True for rows no model may learn from: crc32 of the id as text, modulo 5, is 0. A null id is held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def map_columns(
    df: DataFrame,
    compute: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    fields: Sequence[T.StructField],
    keep: Sequence[str],
) -> DataFrame:
    """Add computed columns, batch by batch, and carry the columns named in ``keep``.

    A computed column replaces a kept one of the same name. Rows keep their order and number.
    """
    new = {f.name for f in fields}
    kept = [c for c in keep if c not in new]
    schema = T.StructType([df.schema[c] for c in kept] + list(fields))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = compute(batch)
                arrays = [batch.column(c) for c in kept] + [columns[c] for c in names]
                yield pa.RecordBatch.from_arrays(arrays, names=kept + names)

    return df.mapInArrow(run, schema)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of undirected edges ``(a, b)``: one row ``(node, component)`` per node of an
    edge, ``component`` being the smallest node reachable.

    Every round moves each node to the first of its neighbourhood and contracts the edges. Nodes are ordered by
    their hash, so that the nodes left about halve whatever the ids are, long sorted chains included, and a star
    takes two rounds. Rounds are cut by written tables; nothing is collected. A node with very many
    edges is met only by partial minima and by joins that the adaptive planner may split.
    """
    spark = edges.sparkSession
    both = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    current = materialise(both, label)
    labels = None
    while not current.isEmpty():
        reach = current.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            current.select(F.col("b").alias("node"), F.col("a").alias("other")))
        step = reach.groupBy("node").agg(F.min_by("other", F.xxhash64("other")).alias("other"))
        step = materialise(step.select("node", F.when(F.xxhash64("other") < F.xxhash64("node"), F.col("other")).otherwise(F.col("node")).alias("parent")), label)
        if labels is None:
            labels = step.withColumnRenamed("parent", "component")
        else:
            # Nodes met earlier follow their component; a component no longer among the nodes is final.
            labels = materialise(
                labels.join(step, labels.component == step.node, "left").select(
                    labels.node, F.coalesce(step.parent, labels.component).alias("component")), label)
        left = step.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = step.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = current.join(left, "a").join(right, "b").where("pa <> pb").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        # A parent may move itself: its own step keeps the chain together.
        current = materialise(moved.distinct(), label)
    if labels is None:
        return spark.createDataFrame([], T.StructType([
            T.StructField("node", edges.schema["a"].dataType), T.StructField("component", edges.schema["a"].dataType)]))
    smallest = labels.groupBy("component").agg(F.min("node").alias("smallest"))
    return labels.join(smallest, "component").select("node", F.col("smallest").alias("component"))
