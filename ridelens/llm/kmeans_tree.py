"""Approximate nearest neighbours with a hierarchical k-means tree.

Method: a tree of k-means centres is fitted on a bounded sample of the vectors
(``SAMPLE`` at most, chosen by a hash of the id); every row is then assigned to
its leaf. A search walks the tree best bin first: a priority queue holds the
branches seen and not taken, nearest centre first, and gives the leaves in the
order of promise. How many leaves are visited is calibrated: a set of trial
queries is compared with brute force over all rows, in blocks, and the visits
widen until their recall reaches ``RECALL``; if no smaller number does, all
leaves are visited. Scores are inner products in double precision on the
original vectors.

Distribution: queries travel to the leaves that they visit, and each leaf is
dealt into shards of about ``SHARD`` rows by a hash of the id, and its queries
into blocks of about as many, so that many equal vectors, which no tree can
part, do not meet in one task. A shard returns each query's best k; a second
step merges them.

Edge cases: vectors that are null, empty, zero, of another length than most, or
hold null or non-finite components take no part, as queries or candidates; rows
with a null id neither; of rows that repeat an id the first by component order
counts; with fewer candidates than k all come; ties go to the smaller id; an
empty table gives an empty result."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelens.llm.shared import materialise, ship

K = 20
BRANCHES, LEAF_ROWS, MAX_DEPTH, ROUNDS = 8, 64, 8, 8
#: Vectors that the tree is fitted on, at most.
SAMPLE = 16_384
#: Trial queries and the recall that the visits must reach on them.
TRIALS, RECALL = 128, 0.97
#: Rows of a leaf that one task scores together.
SHARD = 8192


@dataclass
class Tree:
    """Node i has the centre ``centres[i]``; its children are
    ``children[i]``, empty for a leaf, whose number is ``leaf[i]``."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def visit(self, query: np.ndarray, limit: int) -> list[int]:
        """The first ``limit`` leaves, best bin first."""
        near = self.centres @ query
        queue, out = [(0.0, 0)], []
        while queue and len(out) < limit:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                out.append(int(self.leaf[node]))
            for child in self.children[node]:
                heapq.heappush(queue, (-float(near[child]), child))
        return out

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: at each node the nearest child's."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
            elif len(rows):
                kids = np.array(self.children[node])
                choice = _nearest(vectors[rows], self.centres[kids])
                todo += [(int(kid), rows[choice == j]) for j, kid in enumerate(kids)]
        return out


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2.0 * (vectors @ centres.T), axis=1)


def _kmeans(vectors: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = vectors[rng.choice(len(vectors), k, replace=False)]
    for _ in range(ROUNDS):
        own = _nearest(vectors, centres)
        counts = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def fit_tree(sample: np.ndarray) -> Tree:
    """A tree over distinct vectors of the sample."""
    sample = np.unique(sample, axis=0)
    rng = np.random.Generator(np.random.PCG64(7))
    centres, children, leaf = [sample.mean(axis=0)], [[]], [-1]
    todo, leaves = [(0, sample, 0)], 0
    while todo:
        node, rows, depth = todo.pop(0)
        if len(rows) <= LEAF_ROWS or depth == MAX_DEPTH:
            leaf[node] = leaves
            leaves += 1
            continue
        kids = _kmeans(rows, min(BRANCHES, len(rows)), rng)
        own = _nearest(rows, kids)
        for j in range(len(kids)):
            if (own == j).any():
                centres.append(kids[j])
                children.append([])
                leaf.append(-1)
                children[node].append(len(centres) - 1)
                todo.append((len(centres) - 1, rows[own == j], depth + 1))
    return Tree(np.array(centres), children, np.array(leaf))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow column of equally long lists of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return flat.reshape(len(column), -1)


def _score(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    # the same bits for the same vector wherever it stands, so that ties are ties
    return (vectors * query).sum(axis=1)


def _best(ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest rows and their scores, ties to the smaller id."""
    score = _score(vectors, query)
    rows = np.flatnonzero(ids != query_id)
    if len(rows) > k:
        least = np.partition(score[rows], len(rows) - k)[len(rows) - k]
        rows = rows[score[rows] >= least]
    rows = rows[np.lexsort((ids[rows], -score[rows]))][:k]
    return rows, score[rows]


_FOUND = "query_id long, vec_id long, score double"


def _found(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([np.full(len(v), q, np.int64) for q, v, _ in parts])),
            pa.array(np.concatenate([v for _, v, _ in parts])),
            pa.array(np.concatenate([s for _, _, s in parts])),
        ],
        names=["query_id", "vec_id", "score"],
    )


def _brute(trial_ids: np.ndarray, trials: np.ndarray, k: int):
    """A map over blocks of rows: each trial query's best of the block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, vectors = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector"))
                found = [(int(q), *_best(ids, vectors, x, int(q), k)) for q, x in zip(trial_ids, trials)]
                yield _found([(q, ids[rows], score) for q, rows, score in found])

    return search


def _top(found: DataFrame, k: int) -> DataFrame:
    """Each query's best k of the found rows."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.coalesce(fine, F.lit(False)))
    rows = rows.where(F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("vector") == (length.n if length else 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


_DEALT = ["leaf", "shard", "block"]


def deal(indexed: DataFrame, queries: DataFrame, shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of a leaf in shards and its queries in blocks, of about SHARD
    each: a query meets every shard, a row every block, each pair once."""
    blocks = queries.groupBy("leaf").agg(F.ceil(F.count("*") / SHARD).alias("blocks"))
    sizes = F.broadcast(shards.join(F.broadcast(materialise(blocks, "leaf-queries")), "leaf"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    stored = indexed.join(sizes, "leaf").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards"))).withColumn("block", every("blocks"))
    asked = queries.join(sizes, "leaf").withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("blocks"))).withColumn("shard", every("shards"))
    return stored.select(*_DEALT, "vec_id", "vector"), asked.select(*_DEALT, "vec_id", "vector")


def search(
    vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k nearest rows found of
    each row of which ``is_query`` (on vec_id) is true, itself left out."""
    spark = vectors.sparkSession
    ship(spark)
    rows = materialise(usable(vectors, id_col, vector_col), "vectors")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    by_hash = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000))
    sample = rows.where(by_hash < max(1, int(min(1.0, SAMPLE / n) * 1_000_000))).limit(2 * SAMPLE).toPandas()
    if not len(sample):
        sample = rows.limit(SAMPLE).toPandas()
    tree = fit_tree(np.stack(sample.vector))

    def to_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.assign(_matrix(batch.column("vector")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "vector", "leaf"])

    indexed = rows.mapInArrow(to_leaf, "vec_id long, vector array<double>, leaf long")
    indexed = materialise(indexed, "leaves")
    shards = indexed.groupBy("leaf").agg(F.ceil(F.count("*") / SHARD).alias("shards"))
    shards = materialise(shards, "leaf-sizes")  # a row for each leaf of the bounded tree

    # trial queries: the queries of the smallest hashes, else any rows
    asked = rows.where(is_query)
    trials = asked.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(TRIALS).toPandas()
    limit = tree.leaves()
    if len(trials):
        points = np.stack(trials.vector)
        ids = trials.vec_id.to_numpy()
        true = _top(rows.mapInArrow(_brute(ids, points, k), _FOUND), k).join(indexed.select("vec_id", "leaf"), "vec_id")
        true = true.select("query_id", "leaf").toPandas()  # k rows a trial at most
        place = {}
        for q, x in zip(ids, points):
            for at, leaf in enumerate(tree.visit(x, limit)):
                place[int(q), leaf] = at
        visits = np.sort([place[int(q), int(leaf)] for q, leaf in zip(true.query_id, true.leaf)])
        if len(visits):
            limit = int(visits[min(len(visits) - 1, int(np.ceil(RECALL * len(visits))) - 1)]) + 1

    def to_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                seen = [tree.visit(x, limit) for x in _matrix(batch.column("vector"))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("vector"), pa.array(seen, pa.list_(pa.int64()))], names=["vec_id", "vector", "seen"]
                )

    queries = materialise(asked.mapInArrow(to_visits, "vec_id long, vector array<double>, seen array<long>"), "visits")
    stored, queries = deal(indexed, queries.select("vec_id", "vector", F.explode("seen").alias("leaf")), shards)

    def score(key: tuple, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        ids, points = own.vec_id.to_numpy(), np.stack(own.vector)
        found = [(int(q), *_best(ids, points, x, int(q), k)) for q, x in zip(asked.vec_id, asked.vector)]
        return _found([(q, ids[at], s) for q, at, s in found]).to_pandas()

    found = stored.groupBy(*_DEALT).cogroup(queries.groupBy(*_DEALT)).applyInPandas(score, _FOUND)
    return _top(found, k)
