"""Z-score cuts (F16, F17, J3, W7; traps T3, T8)."""

import pytest

from conftest import plan_of
from ridelens.operators.outliers import drop_zscore, zscore, zscore_stats


def test_pop_versus_sample_sd(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int")
    pop = zscore_stats(df, "x", "pop").first()
    samp = zscore_stats(df, "x", "samp").first()
    assert pop["__sd"] == pytest.approx(1.118, abs=1e-3)
    assert samp["__sd"] == pytest.approx(1.291, abs=1e-3)


def test_sql_cut_keeps_boundary_and_null(spark):
    # Ten zeros and one 10: pop z of the 10 is exactly sqrt(10) > 3.
    data = [(0,)] * 10 + [(10,), (None,)]
    df = spark.createDataFrame(data, "x int")
    out = drop_zscore(df, "x")
    vals = sorted((r.x is None, r.x) for r in out.collect())
    assert vals.count((False, 0)) == 10 and (True, None) in vals and (False, 10) not in vals


def test_constant_column(spark):
    df = spark.createDataFrame([(5,), (5,), (5,)], "x int")
    # SD 0: the SQL form keeps every row, the R form drops every row.
    assert drop_zscore(df, "x").count() == 3
    assert drop_zscore(df, "x", sd="samp", strict=True).count() == 0
    assert [r.z for r in zscore(df, "x").collect()] == [None, None, None]


def test_strict_drops_exactly_k(spark):
    # Values -1, +1 repeated: pop SD 1, mean 0, so z = +-1; with k=1 the SQL
    # form keeps them (abs(z) > 1 is false), the strict form drops them.
    df = spark.createDataFrame([(-1,), (1,)] * 3, "x int")
    assert drop_zscore(df, "x", k=1.0).count() == 6
    assert drop_zscore(df, "x", k=1.0, strict=True).count() == 0


def test_plan_reads_stats_as_scalar_subquery(spark):
    df = spark.range(1000).selectExpr("cast(id as int) as x")
    plan = plan_of(drop_zscore(df, "x"))
    assert "Subquery" in plan
    assert "NestedLoopJoin" not in plan and "Window" not in plan


def test_mean_scale_rounds_exact_average_once(spark):
    # Mean 2/3 -> 0.6667 with four decimals, computed from the exact sum and count.
    df = spark.createDataFrame([(0,), (1,), (1,)], "x int")
    r = zscore_stats(df, "x", "pop", mean_scale=4).first()
    assert r["__mean"] == 0.6667
    d = spark.createDataFrame([(0.5,), (1.0,)], "x double")
    assert zscore_stats(d, "x", "pop", mean_scale=4).first()["__mean"] == 0.75
