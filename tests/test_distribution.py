"""Histogram and box-plot statistics (A22, A23; trap T10)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridelens.operators.distribution import boxplot_outliers, boxplot_stats, histogram


def test_histogram_bins(spark):
    df = spark.createDataFrame([(x,) for x in [2, 3, 4, 5, 5, 10]], "duration int")
    out = {r.bin: r.n for r in histogram(df, "duration", 2.0).collect()}
    assert out == {2.0: 2, 4.0: 3, 10.0: 1}


def test_histogram_lowest_edge(spark):
    # The minimum 1 sits on an edge: the first bin [1, 3] takes it.
    df = spark.createDataFrame([(x,) for x in [1, 2, 3, 7]], "duration int")
    out = {r.bin: r.n for r in histogram(df, "duration", 2.0).collect()}
    assert out == {2.0: 3, 6.0: 1}
    # An edge value that is not the minimum goes to the lower bin.
    df2 = spark.createDataFrame([(x,) for x in [0, 1, 3]], "duration int")
    out2 = {r.bin: r.n for r in histogram(df2, "duration", 2.0).collect()}
    assert out2 == {0.0: 2, 2.0: 1}


def test_histogram_counts_equal_rows(spark):
    df = spark.range(500).select((F.col("id") % 97).cast("int").alias("duration"), (F.col("id") % 2 == 0).alias("member"))
    h = histogram(df, "duration", 2.0, by=["member"])
    assert h.agg(F.sum("n")).first()[0] == 500


def _reference_box(values, coef=1.5):
    v = np.array(sorted(values), dtype=float)
    q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])  # linear interpolation
    iqr = q3 - q1
    inside = v[(v >= q1 - coef * iqr) & (v <= q3 + coef * iqr)]
    out = v[(v < q1 - coef * iqr) | (v > q3 + coef * iqr)]
    return q1, q2, q3, inside.min(), inside.max(), len(out)


def test_boxplot_matches_linear_quantiles(spark):
    rng = np.random.default_rng(7)
    vals = [int(x) for x in rng.gamma(2.0, 8.0, size=400)] + [200, 250]
    df = spark.createDataFrame([(v, v % 2 == 0) for v in vals], "duration int, member boolean")
    for approx in (False,):
        got = {r.member: r for r in boxplot_stats(df, "duration", ["member"], approx=approx).collect()}
        for m in (True, False):
            q1, q2, q3, lo, hi, n_out = _reference_box([v for v in vals if (v % 2 == 0) == m])
            r = got[m]
            assert (r.lower, r.middle, r.upper) == pytest.approx((q1, q2, q3))
            assert (r.ymin, r.ymax, r.n_outliers) == (lo, hi, n_out)
    outliers = boxplot_outliers(df, "duration", ["member"])
    assert outliers.agg(F.sum("n")).first()[0] == sum(r.n_outliers for r in got.values())


def test_boxplot_approx_runs(spark):
    df = spark.range(1000).select((F.col("id") % 50).cast("double").alias("duration"), F.lit(True).alias("member"))
    r = boxplot_stats(df, "duration", ["member"], approx=True).first()
    assert 10 <= r.lower <= 14 and 23 <= r.middle <= 26


@pytest.mark.parametrize("buckets", [4, 64])
def test_bucketed_quantiles_equal_window(spark, buckets):
    from ridelens.operators.distribution import bucketed_quantiles, value_counts

    rng = np.random.default_rng(11)
    ints = [int(v) for v in rng.gamma(2.0, 8.0, size=700)]
    conts = [float(v) for v in rng.normal(0, 5, size=300)]
    rows = [("a", float(v)) for v in ints] + [("b", v) for v in conts] + [("c", 7.0)] + [("d", 1.0), ("d", 3.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    vc = value_counts(df, "x", ["g"])
    got = {r.g: (r.n, list(r["__q"])) for r in bucketed_quantiles(vc, ["g"], "x", buckets=buckets).collect()}
    for g in ("a", "b", "c", "d"):
        vals = [v for k, v in rows if k == g]
        exp = list(np.quantile(np.array(vals), [0.25, 0.5, 0.75]))
        assert got[g][0] == len(vals)
        assert got[g][1] == pytest.approx(exp, rel=1e-12, abs=1e-12)
    whole = bucketed_quantiles(value_counts(df, "x", []), [], "x", buckets=buckets).first()
    assert list(whole["__q"]) == pytest.approx(list(np.quantile(np.array([v for _, v in rows]), [0.25, 0.5, 0.75])))


def test_boxplot_methods_agree(spark):
    rng = np.random.default_rng(3)
    vals = [int(x) for x in rng.gamma(2.0, 8.0, size=500)] + [300, 400]
    df = spark.createDataFrame([(v, v % 3 == 0) for v in vals], "duration int, member boolean")
    a = sorted(tuple(r) for r in boxplot_stats(df, "duration", ["member"]).collect())
    b = sorted(tuple(r) for r in boxplot_stats(df, "duration", ["member"], method="bucketed").collect())
    assert a == b
    oa = sorted(tuple(r) for r in boxplot_outliers(df, "duration", ["member"]).collect())
    ob = sorted(tuple(r) for r in boxplot_outliers(df, "duration", ["member"], method="bucketed").collect())
    assert oa == ob
