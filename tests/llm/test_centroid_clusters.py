import hashlib

import numpy as np

from ridelens.llm.centroid_clusters import cluster, nearest

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "other", 0.5) for i, v in rows], SCHEMA)


def brute_force(rows, k, rounds, dims, scale, seed):
    """Plain k-means in Python integers: (id, cluster, distance) and centroids."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def assign():
        out = []
        for i, v in kept:
            each = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((i, each.index(min(each)), min(each)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (_, x, _) in zip(kept, own) if x == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    return assign(), centroids


def check(spark, rows, k=4, rounds=5, dims=6, scale=16):
    got = cluster(frame(spark, rows), k, rounds, dims, scale).collect()
    want, centroids = brute_force(rows, k, rounds, dims, scale, "3")
    order = lambda t: (t[0] is None, t)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=order) == sorted(want, key=order)
    for r in got:
        own = [d for _, c, d in want if c == r.cluster]
        assert (r.cluster_inertia, r.inertia) == (sum(own), sum(d for _, _, d in want))
        text = ",".join(map(str, centroids[r.cluster]))
        assert r.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert 1 <= r.met <= k


def test_equals_plain_kmeans_with_ties_copies_and_bad_rows(spark):
    rng = np.random.Generator(np.random.PCG64(5))
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(240)]
    rows += [(1000 + i, [0.5, -0.5, 0.25, 0.0, 0.0, 1.0]) for i in range(120)]  # a third of all
    rows += [(7, rows[7][1]), (None, [1.0] * 6), (2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0] * 7)]
    rows += [(2004, [None] + [1.0] * 5), (2005, [float("nan")] * 6), (2006, [float("inf")] + [0.0] * 5), (2007, [-0.0] * 6)]
    check(spark, rows)


def test_equal_starts_leave_a_centroid_without_vectors(spark):
    check(spark, [(i, [1.0] * 6) for i in range(20)])


def test_fewer_vectors_than_centroids_and_none(spark):
    check(spark, [(1, [1.0] * 6), (2, [2.0] * 6)])
    empty = cluster(frame(spark, [(1, None)]), dims=6)
    assert empty.count() == 0 and empty.columns[:3] == ["vec_id", "cluster", "distance"]


def test_large_components_are_exact_and_too_large_distances_null(spark):
    check(spark, [(i, [float(1 << 23) * (i % 3), 1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(9)], k=2, rounds=3, scale=64)
    far = [(0, [2.0e9, -2.0e9]), (1, [-2.0e9, 2.0e9]), (2, [2.0e9, 2.0e9]), (3, [3.0e9, 0.0])]
    got = cluster(frame(spark, far), 1, 0, 2, 1).collect()
    assert len(got) == 3  # the last is beyond 2^31
    assert {r.distance for r in got} <= {0, 16 * 10**18, None} and None in {r.distance for r in got}
    assert all(r.cluster_inertia is None and r.inertia is None for r in got)


def test_walk_meets_few_centroids_and_still_finds_the_nearest():
    rng = np.random.Generator(np.random.PCG64(9))
    centroids = rng.integers(-1000, 1000, (200, 3))
    centroids[50] = centroids[3]
    points = rng.integers(-1000, 1000, (500, 3))
    points[:5] = centroids[50]
    best, distance, met = nearest(points, centroids)
    each = ((points[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (best == each.argmin(axis=1)).all() and (distance == each.min(axis=1)).all()
    assert (best[:5] == 3).all() and met.mean() < 100
