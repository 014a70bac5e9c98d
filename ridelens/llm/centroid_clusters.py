"""k-means on integer vectors, each assignment by the threshold algorithm.

Method: for every dimension the centroids' values are kept in a sorted list.
A vector walks each list outward from its own value, all lists one step at a
time, the nearer of its two neighbours first; a centroid met for the first time
in any list gets its exact squared distance. The squares of the last steps, one
for each list, sum up to the frontier distance, which no centroid unmet so far
can be below. The walk ends when that sum strictly exceeds the best exact
distance, so that centroids equally far are all met and the smaller number wins.
The walks of a batch of vectors run side by side as arrays.

Components are ``floor(SCALE * x)``. All sums and distances are exact integers,
so the result depends neither on the order of rows nor on the partitioning.
Centroids start as the ``k`` vectors of the smallest SHA-256 of ``seed:id``;
each round assigns every vector and replaces a centroid that has vectors by
their mean, rounded down; one that has none stays.

Distribution: the integer vectors are written once. A round is one pass over
them; a task returns one row for each centroid that it met, with the number and
the sums of its vectors, and these partial sums are added up by cluster. The
driver holds k centroids of as many components, whatever the number of rows.

Edge cases: vectors of another length than ``dims``, null ones, and ones with
null or non-finite components take no part; nor do vectors with a component
beyond 2^31 in size after scaling, whose distances do not fit a long; a distance
or sum of distances that does not fit a long is null. Rows that repeat an id
count each; those with a null id too, though they start a centroid only when
there are fewer than k others. Of rows with equal hashes the smaller vector
starts first. With fewer than k vectors there are as many centroids as vectors.
Other columns are ignored; an empty table gives an empty one."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelens.llm.shared import materialise, ship

K, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, "3"
#: Vectors that walk side by side.
BATCH = 2048
#: Components beyond this size take no part.
LARGEST = 1 << 31
#: Up to this size, squared distances of 2^8 dimensions fit 64 bits.
_NARROW = 1 << 26


def _square_dtype(*arrays: np.ndarray) -> type:
    """int64, or exact Python integers where squares could leave it."""
    wide = any(a.size and max(-int(a.min()), int(a.max())) > _NARROW for a in arrays)
    return object if wide else np.int64


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of the integer points the number of the nearest centroid, the
    squared distance, and how many centroids the walk met."""
    n, d = points.shape
    k = len(centroids)
    kind = _square_dtype(points, centroids)
    if kind is np.int64 and d > 1 << 8:
        kind = object
    points, centroids = points.astype(kind), centroids.astype(kind)
    order = np.argsort(centroids, axis=0, kind="stable")  # per dimension, the centroids by value
    values = np.take_along_axis(centroids, order, axis=0)
    # the next list entry on either side of each own value
    right = np.stack([np.searchsorted(values[:, j], points[:, j]) for j in range(d)], axis=1) if n else np.empty((0, d), np.int64)
    left = right - 1
    met = np.zeros((n, k), bool)
    best = np.full(n, -1, np.int64)
    distance = np.zeros(n, kind)
    column = np.arange(d)
    going = np.arange(n)
    while len(going):
        own, low, high = points[going], left[going], right[going]
        down = own - values[np.maximum(low, 0), column]
        up = values[np.minimum(high, k - 1), column] - own
        take_left = (low >= 0) & ((high >= k) | (down <= up))
        at = np.where(take_left, low, high)
        step = np.where(take_left, down, up)
        left[going], right[going] = low - take_left, high + ~take_left
        # centroids met for the first time get their exact distance
        new = np.zeros((len(going), k), bool)
        new[np.repeat(np.arange(len(going)), d), order[at, column].ravel()] = True
        new &= ~met[going]
        met[going] |= new
        for c in np.flatnonzero(new.any(axis=0)):
            rows = np.flatnonzero(new[:, c])
            who = going[rows]
            gap = own[rows] - centroids[c]
            exact = (gap * gap).sum(axis=1)
            closer = (best[who] < 0) | (exact < distance[who]) | ((exact == distance[who]) & (c < best[who]))
            best[who[closer]], distance[who[closer]] = c, exact[closer]
        frontier = (step * step).sum(axis=1)
        # ends beyond the best distance, or with every list walked to its ends
        more = (frontier <= distance[going]) & ~met[going].all(axis=1)
        going = going[more.astype(bool)]
    return best, distance, met.sum(axis=1)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            yield batch.slice(start, BATCH)


def _sums(centroids: np.ndarray):
    """Per task: the number and the component sums of each centroid's vectors."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in _batches(batches):
            points = _matrix(batch.column("vector"), dims)
            cluster, _, _ = nearest(points, centroids)
            count += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                total[c] += points[cluster == c].sum(axis=0)
        some = np.flatnonzero(count)
        if len(some):
            lists = pa.array(total[some].tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some]), lists], names=["cluster", "n", "sums"])

    return run


def _assign(centroids: np.ndarray):
    dims = centroids.shape[1]
    largest = (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            cluster, distance, met = nearest(_matrix(batch.column("vector"), dims), centroids)
            fits = pa.array([int(x) if x <= largest else None for x in distance.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), fits, pa.array(met.astype(np.int32))],
                names=["vec_id", "cluster", "distance", "met"],
            )

    return run


def scaled(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector (integers) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < LARGEST))
    rows = rows.where((F.size("vector") == dims) & F.coalesce(fine, F.lit(False)))
    return rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("long")))


def start_key(id_col: Column, seed: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")).cast("binary"), 256)


def _next(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    parts = rows.select("vector").mapInArrow(_sums(centroids), "cluster long, n long, sums array<long>")
    cells = parts.select("cluster", "n", F.posexplode("sums").alias("dim", "part"))
    # exact even where a sum leaves 64 bits; k rows for each dimension
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    out = centroids.copy()
    for r in cells.groupBy("cluster", "dim").agg(wide("n").alias("n"), wide("part").alias("total")).collect():
        out[r.cluster, r.dim] = int(r.total) // int(r.n)
    return out


def cluster(
    vectors: DataFrame,
    k: int = K,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: str = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per vector that takes part: vec_id, cluster, distance (squared),
    cluster_inertia and inertia (distance summed over its cluster and over
    all), centroid_sha256 (of the final centroid's components, decimal and
    joined by commas) and met (centroids that its last walk met)."""
    spark = vectors.sparkSession
    ship(spark)
    rows = materialise(scaled(vectors, dims, scale, id_col, vector_col), "integer-vectors")
    first = rows.orderBy(start_key(F.col("vec_id"), seed).asc_nulls_last(), "vector").limit(k).collect()
    if not first:
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, met int"
        )
    centroids = np.array([r.vector for r in first], np.int64)
    for _ in range(rounds):
        moved = _next(rows, centroids)
        if (moved == centroids).all():
            break  # every further round would give the same
        centroids = moved
    own = materialise(rows.mapInArrow(_assign(centroids), "vec_id long, cluster int, distance long, met int"), "clusters")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    names = F.array(*map(F.lit, digests))
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = own.groupBy("cluster").agg(whole.alias("part"))  # k rows at most
    parts = {r.cluster: r.part for r in sums.collect()}
    total = None if any(p is None for p in parts.values()) else sum(parts.values())
    long_of = lambda x: F.lit(int(x) if x is not None and x < 1 << 63 else None).cast("long")
    inertia = F.array(*(long_of(parts.get(c)) for c in range(len(centroids))))
    return own.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(inertia, F.col("cluster")).alias("cluster_inertia"),
        long_of(total).alias("inertia"),
        F.get(names, F.col("cluster")).alias("centroid_sha256"),
        "met",
    )
