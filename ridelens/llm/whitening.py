"""Whitening of embeddings by the leading eigenvectors of their covariance.

Method: components become integers ``floor(SCALE * c)``. The fit list holds each
distinct integer vector once; its covariance (divisor n) comes from exact
integer sums, centred on the rounded mean before multiplying and corrected for
the rest of the mean, so that it depends neither on the order of rows nor on the
partitioning. Its leading eigenpairs are isolated by spectrum slicing (counts of
LDL^T inertia), refined by Rayleigh quotient iteration and numbered by counts
(``spectrum``). A whitened value is the centred vector projected on a component,
over the square root of its eigenvalue.

Distribution: equal vectors are merged where they are read, before the shuffle
that makes the fit list, which is written once; sums, products and the covariance
of the whitened fit list are three passes over it that return a number for each
pair of dimensions at most; only those reach the driver, where the eigenpairs of
a dims x dims matrix are found. Rows are whitened without a shuffle.

Edge cases: null vectors, and ones with null or non-finite entries, take no part;
nor do empty ones, vectors of another length than most (of lengths equally
frequent the smaller counts), and ones with an entry beyond 2^31 in size after
scaling. Rows that repeat are whitened each and count once in the fit; a null
vec_id is kept. Components whose eigenvalue is 0 (fewer distinct vectors than
components, dimensions that depend on others) have null whitened values and do
not enter identity_error; when all eigenvalues are 0, explained and
identity_error are null. A deviation beyond a long is null. Vectors with fewer
dimensions than COMPONENTS have as many components as dimensions. Other columns
are ignored; an empty table gives an empty one."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm.shared import materialise, ship
from ridelens.llm.spectrum import leading

COMPONENTS, SCALE = 4, 256
LARGEST = 1 << 31
#: Vectors handled side by side.
BATCH = 4096
#: Eigenvalues below this share of the trace count as 0.
ZERO = 1e-12


@dataclass
class Model:
    """n and sums of the fit list, eigenvalues and unit eigenvectors (columns,
    falling), the trace, and whether counts certified every number."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    certified: bool

    def positive(self) -> np.ndarray:
        return self.values > ZERO * self.trace if self.trace > 0 else np.zeros(len(self.values), bool)

    def project(self, points: np.ndarray) -> np.ndarray:
        """Whitened values of integer vectors, a column per component with a
        positive eigenvalue, NaN in the others."""
        mean = np.array([float(Fraction(s, self.n)) for s in self.sums])
        out = np.full((len(points), len(self.values)), np.nan)
        some = self.positive()
        out[:, some] = (points - mean) @ self.vectors[:, some] / np.sqrt(self.values[some])
        return out


def scaled(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """vec_id and vector (integers) of the rows that take part, and their length."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < LARGEST))
    rows = rows.where((F.size("vector") > 0) & F.coalesce(fine, F.lit(False)))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("long")))
    rows = materialise(rows, "integer-vectors")
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dims = length.n if length else 0
    return rows.where(F.size("vector") == dims), dims


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            yield _matrix(batch.column("vector").slice(start, BATCH), dims)


def _sums(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(dims, np.int64)
        for points in _blocks(batches, dims):
            count += len(points)
            total += points.sum(axis=0)
        if count:
            yield pa.RecordBatch.from_arrays([pa.array([count]), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n", "sums"])

    return run


def exact_gram(points: np.ndarray) -> np.ndarray:
    """The sum of the outer products of integer rows, as Python integers."""
    largest = max(int(points.max(initial=0)), -int(points.min(initial=0)), 1)
    # products of doubles are exact below 2^53
    if largest * largest * len(points) < 1 << 53:
        x = points.astype(float)
        return (x.T @ x).astype(np.int64).astype(object)
    if largest < 1 << 30:
        # two halves of 15 bits or so each keep every partial product small
        high = points >> 15
        low = points - (high << 15)
        h, lo = high.astype(float), low.astype(float)
        if (1 << 30) * len(points) < 1 << 53:
            hh, hl, ll = h.T @ h, h.T @ lo, lo.T @ lo
            whole = [m.astype(np.int64).astype(object) for m in (hh, hl, ll)]
            return whole[0] * (1 << 30) + (whole[1] + whole[1].T) * (1 << 15) + whole[2]
    x = points.astype(object)
    return x.T @ x


def _products(shift: np.ndarray):
    """Per task: the upper triangle of the sum of outer products of the rows
    less ``shift``, as decimal text, since it can leave 64 bits."""
    dims = len(shift)
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        some = False
        for points in _blocks(batches, dims):
            total = total + exact_gram(points - shift)
            some = some or len(points) > 0
        if some:
            cells = pa.array([[str(x) for x in total[upper]]], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([cells], names=["cells"])

    return run


def covariance(rows: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums and the covariance (divisor n) of integer vectors, the
    exact one rounded once to doubles."""
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    parts = rows.select("vector").mapInArrow(_sums(dims), "n long, sums array<long>")
    cells = parts.select("n", F.posexplode("sums").alias("dim", "part")).groupBy("dim").agg(wide("n").alias("n"), wide("part").alias("total"))
    by_dim = {r.dim: (int(r.n), int(r.total)) for r in cells.collect()}  # a row for each dimension
    n, sums = by_dim[0][0], [by_dim[j][1] for j in range(dims)]
    shift = [round(Fraction(s, n)) for s in sums]
    products = rows.select("vector").mapInArrow(_products(np.array(shift, np.int64)), "cells array<string>")
    cells = products.select(F.posexplode("cells").alias("cell", "part")).groupBy("cell").agg(wide("part").alias("total"))
    by_cell = {r.cell: int(r.total) for r in cells.collect()}  # a row for each pair of dimensions
    rest = [s - n * m for s, m in zip(sums, shift)]  # what the rounded mean left
    out = np.empty((dims, dims))
    for cell, (i, j) in enumerate(zip(*np.triu_indices(dims))):
        out[i, j] = out[j, i] = float(Fraction(n * by_cell[cell] - rest[i] * rest[j], n * n))
    return n, sums, out


def fit(fit_list: DataFrame, dims: int, components: int = COMPONENTS) -> Model:
    n, sums, v = covariance(fit_list, dims)
    pairs, trace = leading(v, components), float(np.trace(v))
    return Model(
        n,
        sums,
        np.array([p.value for p in pairs]),
        np.array([p.vector for p in pairs]).T,
        trace,
        all(p.certified for p in pairs if p.value > ZERO * trace),
    )


def identity_error(fit_list: DataFrame, model: Model) -> float | None:
    """The largest entry of the whitened fit list's covariance minus the
    identity, over the components with a positive eigenvalue."""
    some = np.flatnonzero(model.positive())
    if not len(some):
        return None
    dims = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, plain = np.zeros((len(some), len(some))), np.zeros(len(some))
        for points in _blocks(batches, dims):
            w = model.project(points)[:, some]
            total += w.T @ w
            plain += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([[*total.ravel(), *plain]], pa.list_(pa.float64()))], names=["cells"])

    parts = fit_list.select("vector").mapInArrow(run, "cells array<double>")
    cells = parts.select(F.posexplode("cells").alias("cell", "part")).groupBy("cell").agg(F.sum("part").alias("total"))
    by_cell = {r.cell: r.total for r in cells.collect()}
    k = len(some)
    second = np.array([by_cell[i] for i in range(k * k)]).reshape(k, k) / model.n
    mean = np.array([by_cell[k * k + i] for i in range(k)]) / model.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


_SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, certified boolean"
)


def deviations(points: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum over dimensions of (n x - S)^2, exact; None beyond a long."""
    reach = max(abs(int(points.max(initial=0))), abs(int(points.min(initial=0))), 1) * n + max(map(abs, sums))
    if reach * reach * len(sums) < 1 << 63:
        gap = points * n - np.array(sums, np.int64)
        return (gap * gap).sum(axis=1).tolist()
    gap = points.astype(object) * n - np.array(sums, object)
    return [int(x) if x < 1 << 63 else None for x in (gap * gap).sum(axis=1)]


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """A row for each vector that takes part and each component: vec_id,
    component (from 1), n, deviation, whitened, explained, identity_error and
    certified (whether counts confirmed the number of every component)."""
    spark = vectors.sparkSession
    ship(spark)
    rows, dims = scaled(vectors, scale, id_col, vector_col)
    if not dims:
        return spark.createDataFrame([], _SCHEMA)
    fit_list = materialise(rows.select("vector").distinct(), "distinct-vectors")
    model = fit(fit_list, dims, components)
    error = identity_error(fit_list, model)
    k = len(model.values)
    explained = model.values / model.trace if model.trace > 0 else np.full(k, np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                points = _matrix(batch.column("vector"), dims)
                m = len(points)
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n, np.int64)),
                        pa.array(deviations(points, model.n, model.sums), pa.int64()).take(pa.array(each)),
                        pa.array(model.project(points).ravel(), from_pandas=True),
                        pa.array(np.tile(explained, m), from_pandas=True),
                        pa.array([error] * (m * k), pa.float64()),
                        pa.array([model.certified] * (m * k), pa.bool_()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "certified"],
                )

    return rows.mapInArrow(run, _SCHEMA)
