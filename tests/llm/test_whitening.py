import numpy as np

from ridelens.llm.spectrum import leading, negative_count
from ridelens.llm.whitening import deviations, exact_gram, whiten

SCHEMA = "vec_id long, embedding array<float>, n string, component double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0.0) for i, v in rows], SCHEMA)


def brute_force(rows, dims, scale=256):
    """numpy's eigenvectors of the distinct integer vectors' covariance."""
    kept = [(i, np.floor(scale * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows if v is not None and len(v) == dims and None not in v and np.isfinite(v).all()]
    x = np.unique([v for _, v in kept], axis=0)
    n, s = len(x), x.sum(axis=0)
    cov = (x - s / n).T @ (x - s / n) / n
    w, u = np.linalg.eigh(cov)
    return kept, n, s, w[::-1], u[:, ::-1], np.trace(cov)


def check(spark, rows, dims):
    got = whiten(frame(spark, rows)).collect()
    kept, n, s, w, u, trace = brute_force(rows, dims)
    k = min(4, dims)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    assert len(got) == k * len(kept)
    for c in range(k):
        sign = None
        for i, x in kept:
            want = (x - s / n) @ u[:, c] / np.sqrt(w[c])
            r = by[i, c + 1][0]
            if sign is None and abs(want) > 1e-6:
                sign = np.sign(want * r.whitened)
            assert abs(r.whitened - (sign or 1) * want) < 1e-9
            assert r.n == n and r.deviation == int(((n * x - s) ** 2).sum())
            assert abs(r.explained - w[c] / trace) < 1e-12 and r.identity_error < 1e-9 and r.certified


def test_equals_numpy_with_copies_and_bad_rows(spark):
    rng = np.random.Generator(np.random.PCG64(8))
    rows = [(i, (rng.normal(size=7) * [3, 2.5, 2, 1.5, 1, 0.5, 0.2]).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(5, rows[5][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 6), (2003, [None] * 7), (2004, [float("nan")] * 7), (2005, [-0.0] * 7)]
    rows += [(2006, [float("-inf")] + [0.0] * 6)]
    check(spark, rows, 7)


def test_few_dimensions(spark):
    check(spark, [(i, [float(i % 5), float(i % 3)]) for i in range(40)], 2)


def test_equal_vectors_have_no_whitened_values(spark):
    got = whiten(frame(spark, [(i, [1.0] * 5) for i in range(6)])).collect()
    assert len(got) == 24
    assert all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None and r.identity_error is None for r in got)


def test_flat_directions_are_null_and_others_whitened(spark):
    got = whiten(frame(spark, [(i, [float(i), float(2 * i), 1.0, 0.0]) for i in range(9)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got)
    first = np.array([r.whitened for r in got if r.component == 1])
    assert abs(first.var() - 1) < 1e-9 and got[0].identity_error < 1e-9
    assert all(abs(r.explained - (r.component == 1)) < 1e-9 for r in got)


def test_empty(spark):
    out = whiten(frame(spark, [(1, None)]))
    assert out.count() == 0 and {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"} <= set(out.columns)


def test_exact_sums():
    rng = np.random.Generator(np.random.PCG64(3))
    for size in (100, 1 << 22, 1 << 29, 1 << 31):
        x = rng.integers(-size, size, (50, 4))
        want = x.astype(object).T @ x.astype(object)
        assert (exact_gram(x) == want).all()
        n, s = 10**6, [int(v) for v in x.sum(axis=0)]
        exact = ((x.astype(object) * n - np.array(s, object)) ** 2).sum(axis=1)
        assert deviations(x, n, s) == [int(v) if v < 1 << 63 else None for v in exact]


def test_spectrum_against_numpy():
    rng = np.random.Generator(np.random.PCG64(1))
    q, _ = np.linalg.qr(rng.normal(size=(8, 8)))
    spectra = [rng.normal(size=8), np.ones(8), np.zeros(8), np.array([5, 5, 5, 1, 1, 0, 0, -3.0]), np.array([1, 1 + 1e-9, 1 - 1e-9, 0.5, 0, 0, 0, 0])]
    for values in spectra:
        a = q @ np.diag(values) @ q.T
        a = (a + a.T) / 2
        pairs = leading(a, 4)
        size = max(1e-300, np.abs(values).max())
        assert np.allclose([p.value for p in pairs], np.sort(values)[::-1][:4], atol=1e-13 * size, rtol=0)
        u = np.array([p.vector for p in pairs])
        assert np.abs(u @ u.T - np.eye(4)).max() < 1e-12
        for p in pairs:
            assert np.linalg.norm(a @ p.vector - p.value * p.vector) <= 1e-12 * size
        for shift in (-3.5, -0.1, 0.3, 2.0):
            assert negative_count(a - shift * np.eye(8)) == (values < shift).sum()
