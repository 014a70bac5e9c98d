import numpy as np
from pyspark.sql import functions as F

from ridelens.llm import kmeans_tree
from ridelens.llm.kmeans_tree import search


def brute_force(ids, x, queries, k):
    out = {}
    for q in queries:
        score = (x * x[np.flatnonzero(ids == q)[0]]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in row], 1.0) for i, row in zip(ids, x)], "vec_id long, embedding array<float>, score double")


def test_recall_order_and_scores(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF_ROWS", 16)
    monkeypatch.setattr(kmeans_tree, "SHARD", 32)
    rng = np.random.Generator(np.random.PCG64(2))
    centres = rng.normal(size=(12, 8))
    x = centres[rng.integers(0, 12, 900)] + 0.3 * rng.normal(size=(900, 8))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32).astype(float)
    x[300:600] = x[0]  # a very common vector
    ids = np.arange(900)
    got = {}
    for r in sorted(search(frame(spark, ids, x), F.col("vec_id") % 20 == 0, k=5).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = brute_force(ids, x, range(0, 900, 20), 5)
    assert set(got) == set(want)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert got[0] == want[0] == [(i, want[0][0][1]) for i in range(300, 305)]


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [0.5, 0.5]), (21, [0.5, 0.5]), (21, [0.5, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in search(vectors, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 20, 0.5), (0, 2, 21, 0.5), (20, 1, 0, 0.5), (20, 2, 21, 0.5)]
    assert search(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert search(vectors.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_queries_of_a_leaf_are_dealt_into_blocks_and_meet_each_row_once(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "SHARD", 32)
    rows = spark.range(300).selectExpr("id as vec_id", "array(1.0D) as vector", "0L as leaf")
    shards = spark.createDataFrame([(0, 10)], "leaf long, shards long")
    stored, asked = kmeans_tree.deal(rows, rows.where("vec_id % 2 = 0"), shards)
    by = ["leaf", "shard", "block"]
    for side in (stored, asked):
        assert max(r["count"] for r in side.groupBy(*by).count().collect()) <= 64
    pairs = stored.withColumnRenamed("vec_id", "row").join(asked.withColumnRenamed("vec_id", "query"), by)
    assert pairs.count() == pairs.select("row", "query").distinct().count() == 300 * 150
