"""Exact k-means on whole numbers by shallot search.

Every vector remembers its centroid, the second nearest one, an upper bound of its distance to the first and a lower
bound to all others. When centroids have moved, the bounds are widened by as much. A vector whose upper bound stays below the lower one,
or below half the way to the next centroid, keeps its centroid unseen. The others are measured to both remembered centroids. The scan
starts from the closer: the other centroids come in the order of their distance from it, and end
where none can be among the two nearest any more; each nearer find shrinks that ball. Bounds are floating-point numbers with a margin,
but vectors are compared by whole numbers, so the result is that of the plain search, ties included.

A round is one pass over the vectors: it writes them with their new bounds and, beside them, each task's sums per
centroid. The sums are added up by Spark; the driver sees one row per centroid and component. A lost executor costs the tasks it ran
in this round. The vectors of the round before last are removed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm.common import discard, working_path

#: Larger components could give distances beyond 64 bits.
LARGEST = 1 << 27
#: Relative error granted to distances taken as floating-point numbers.
MARGIN = 1e-9
#: Columns a vector carries from round to round beside its components.
STATE = "vec_id {id}, v binary, a int, s int, upper double, lower double, distance long"


@dataclass(frozen=True)
class ClusterSettings:
    """``k`` centroids over ``dims`` components, ``rounds`` rounds; components are scaled by ``scale`` and cut down to whole numbers. ``salt``
    stands before the id in the text whose hash picks the first centroids."""

    k: int = 8
    dims: int = 64
    rounds: int = 10
    scale: int = 1024
    salt: str = "3:"


@dataclass(frozen=True)
class Clustering:
    """``rows`` are ``(vec_id, cluster, distance)``; ``centroids`` the final ones; ``totals`` per centroid its number of vectors and the sum
    of their distances; ``measured`` the distances computed in each pass, of which the plain search computes k per vector."""

    rows: DataFrame
    centroids: np.ndarray
    totals: dict[int, tuple[int, int]]
    measured: list[int]


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, row by row, exact in 64 bits."""
    away = x.astype(np.int64) - y
    return np.einsum("ij,ij->i", away, away)


def search(v: np.ndarray, centroids: np.ndarray, a: np.ndarray, s: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """Move each vector to its nearest centroid, of equal ones the smaller number; the four arrays of state are changed in
    place. Returns how many distances were computed."""
    k = len(centroids)
    if k == 1:
        a[:], s[:], upper[:], lower[:] = 0, 0, 0.0, np.inf
        return 0
    between = np.sqrt(np.array([squares(centroids, c) for c in centroids], dtype=np.float64))
    order = np.argsort(between, axis=1, kind="stable")
    half = np.where(np.eye(k, dtype=bool), np.inf, between).min(axis=1) / 2
    wide = 1 + MARGIN

    def undecided(rows: np.ndarray) -> np.ndarray:
        return rows[upper[rows] * wide >= np.maximum(lower[rows], half[a[rows]])]

    rows = undecided(np.arange(len(v)))
    first = squares(v[rows], centroids[a[rows]])
    count = len(rows)
    upper[rows] = np.sqrt(first)
    still = undecided(rows)
    first = first[np.isin(rows, still, assume_unique=True)]
    rows = still
    if not len(rows):
        return count
    x = v[rows]
    one, two = a[rows].copy(), s[rows].copy()
    second = squares(x, centroids[two])
    count += len(rows)
    swap = (second < first) | ((second == first) & (two < one))
    one[swap], two[swap] = two[swap], one[swap]
    first[swap], second[swap] = second[swap], first[swap]
    start, reach = one.copy(), np.sqrt(first)
    known = two.copy()
    live = np.arange(len(rows))
    for rank in range(k):
        other = order[start[live], rank]
        # Sorted by their way from the start: what follows lies outside the ball as well.
        inside = between[start[live], other] <= (reach[live] + np.sqrt(second[live])) * wide
        live, other = live[inside], other[inside]
        if not len(live):
            break
        new = (other != start[live]) & (other != known[live])
        at, c = live[new], other[new]
        d = squares(x[at], centroids[c])
        count += len(at)
        ahead = (d < first[at]) | ((d == first[at]) & (c < one[at]))
        behind = ~ahead & ((d < second[at]) | ((d == second[at]) & (c < two[at])))
        two[at[ahead]], second[at[ahead]] = one[at[ahead]], first[at[ahead]]
        one[at[ahead]], first[at[ahead]] = c[ahead], d[ahead]
        two[at[behind]], second[at[behind]] = c[behind], d[behind]
    a[rows], s[rows], upper[rows], lower[rows] = one, two, np.sqrt(first), np.sqrt(second)
    return count


def widen(moved: np.ndarray, a: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
    """Bounds after centroids moved by the given distances."""
    far = int(moved.argmax())
    next_far = np.delete(moved, far).max() if len(moved) > 1 else 0.0
    upper += moved[a] * (1 + MARGIN)
    np.maximum((lower - np.where(a == far, next_far, moved[far]) * (1 + MARGIN)) * (1 - MARGIN), 0, out=lower)


def _components(column: pa.Array, s: ClusterSettings) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, s.dims)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * s.scale)
    if len(scaled) and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST // s.scale} give distances that do not fit 64 bits")
    return scaled.astype("<i4")


def valid_vectors(embeddings: DataFrame, s: ClusterSettings, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, v)`` of the vectors with ``dims`` components, none null or non-finite."""
    source = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return source.where((F.size("v") == s.dims) & F.coalesce(fine, F.lit(False)))


def first_centroids(vectors: DataFrame, s: ClusterSettings) -> np.ndarray:
    """The components of the ``k`` vectors whose id has the smallest hash; rows of one id in the order of their components."""
    name = F.sha2(F.concat(F.lit(s.salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = vectors.orderBy(name, "v").limit(s.k).toArrow()
    return _components(chosen.column("v").combine_chunks(), s).astype(np.int64)


def _pass(vectors: DataFrame, path: str, centroids: np.ndarray, moved: np.ndarray | None, s: ClusterSettings) -> None:
    """Write every vector with its new state, and per task the sums of each centroid's vectors, below ``path``."""
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, members, spread, measured = np.zeros((k, s.dims), dtype=np.int64), np.zeros(k, dtype=np.int64), [0] * k, 0
        id_arrow = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column("vec_id")
            id_arrow = ids.type
            if moved is None:
                v = _components(batch.column("v"), s)
                a, second = np.zeros(n, dtype=np.int32), np.full(n, min(1, k - 1), dtype=np.int32)
                upper, lower = np.full(n, np.inf), np.zeros(n)
            else:
                v = np.frombuffer(b"".join(batch.column("v").to_pylist()), dtype="<i4").reshape(n, s.dims)
                a, second, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("a", "s", "upper", "lower"))
                widen(moved, a, upper, lower)
            measured += search(v, centroids, a, second, upper, lower)
            distance = squares(v, centroids[a])
            np.add.at(sums, a, v)
            members += np.bincount(a, minlength=k)
            for c in np.unique(a):
                spread[c] += sum(distance[a == c].tolist())
            raw = v.tobytes()
            width = 4 * s.dims
            packed = pa.array([raw[i:i + width] for i in range(0, len(raw), width)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(["v"] * n), ids, packed, pa.array(a, pa.int32()), pa.array(second, pa.int32()), pa.array(upper), pa.array(lower),
                 pa.array(distance), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.int64()))], names=names)
        if id_arrow is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(["s"] * k), pa.nulls(k, id_arrow), pa.nulls(k, pa.binary()), pa.array(range(k), pa.int32()), pa.nulls(k, pa.int32()),
                 pa.nulls(k, pa.float64()), pa.nulls(k, pa.float64()), pa.array([measured] + [0] * (k - 1), pa.int64()), pa.array(members),
                 pa.array([str(x) for x in spread]), pa.array(sums.tolist(), pa.list_(pa.int64()))], names=names)

    names = ["part", "vec_id", "v", "a", "s", "upper", "lower", "distance", "members", "spread", "sums"]
    schema = f"part string, {STATE.format(id=id_type)}, members long, spread string, sums array<long>"
    vectors.mapInArrow(run, schema).write.partitionBy("part").parquet(path)


def _read(spark: SparkSession, path: str, part: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/part={part}")


def _totals(spark: SparkSession, path: str, k: int, dims: int) -> tuple[np.ndarray, list[int], list[int], int]:
    """Sums per centroid of all tasks: components, members, distances, distances computed. Bounded by ``k`` times ``dims`` rows."""
    sums = _read(spark, path, "s", "a int, distance long, members long, spread string, sums array<long>")
    wide = "decimal(38,0)"
    heads = sums.groupBy("a").agg(F.sum("members").alias("members"), F.sum(F.col("spread").cast(wide)).alias("spread"), F.sum("distance").alias("measured"))
    added = sums.select("a", F.posexplode("sums").alias("at", "x")).groupBy("a", "at").agg(F.sum(F.col("x").cast(wide)).alias("x"))
    table = [[0] * dims for _ in range(k)]
    for row in added.collect():
        table[row["a"]][row["at"]] = int(row["x"])
    members, spread, measured = [0] * k, [0] * k, 0
    for row in heads.collect():
        members[row["a"]], spread[row["a"]] = row["members"], int(row["spread"])
        measured += row["measured"]
    return np.array(table, dtype=object), members, spread, measured


def cluster(embeddings: DataFrame, s: ClusterSettings = ClusterSettings(), vec_id: str = "vec_id", vector: str = "embedding") -> Clustering:
    """Cluster the valid vectors; others, null vectors among them, have no row.

    Repeated ids are vectors of their own. A null id counts as an empty text where ids are hashed. Fewer vectors than
    centroids give as many centroids as vectors; none give no rows. A centroid without vectors stays where it is.
    Other columns are ignored. Components whose distances might not fit 64 bits raise an error.
    """
    spark = embeddings.sparkSession
    vectors = valid_vectors(embeddings, s, vec_id, vector)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    centroids, moved, measured = first_centroids(vectors, s), None, []
    k = len(centroids)
    if not k:
        return Clustering(spark.createDataFrame([], f"vec_id {id_type}, cluster int, distance long"), centroids, {}, [])
    paths: list[str] = []
    for done in range(s.rounds + 1):
        paths.append(working_path(spark, f"clusters-{done}"))
        _pass(vectors, paths[-1], centroids, moved, s)
        if len(paths) > 2:
            discard(spark, paths[-3])
        vectors = _read(spark, paths[-1], "v", STATE.format(id=id_type))
        sums, members, spread, new = _totals(spark, paths[-1], k, s.dims)
        measured.append(new)
        if done < s.rounds:
            before = centroids
            centroids = np.array([[x // members[c] for x in sums[c]] if members[c] else before[c].tolist() for c in range(k)], dtype=np.int64)
            moved = np.sqrt(squares(centroids, before).astype(np.float64))
    rows = vectors.select("vec_id", F.col("a").alias("cluster"), "distance")
    return Clustering(rows, centroids, {c: (members[c], spread[c]) for c in range(k)}, measured)


def centroid_hash(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def with_totals(found: Clustering) -> DataFrame:
    """The rows with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    if not found.totals:
        return found.rows.selectExpr("*", "CAST(NULL AS BIGINT) AS cluster_inertia", "CAST(NULL AS BIGINT) AS inertia", "CAST(NULL AS STRING) AS centroid_sha256")

    def lookup(values: dict) -> F.Column:
        pairs = [F.lit(x) for pair in values.items() for x in pair]
        return F.element_at(F.create_map(*pairs), F.col("cluster"))

    whole = sum(spread for _, spread in found.totals.values())
    if whole >= 1 << 63:
        raise OverflowError("the sum of all distances does not fit 64 bits")
    inertia = {c: spread for c, (_, spread) in found.totals.items()}
    hashes = {c: centroid_hash(x) for c, x in enumerate(found.centroids)}
    return found.rows.select(
        "*", lookup(inertia).cast("long").alias("cluster_inertia"), F.lit(whole).cast("long").alias("inertia"), lookup(hashes).alias("centroid_sha256"))
