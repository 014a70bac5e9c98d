"""Positions, running totals and ordered files over frames of any size."""

import glob
import os

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import plan_of
from ridelens.operators.ordered import ordered, write_ordered
from ridelens.operators.rollup import top_stations
from ridelens.operators.share import cumulative


def test_a_million_rows_equal_numpy(spark):
    n = 1_000_000
    df = spark.range(n).select(
        F.col("id").alias("key"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(97)).alias("x")
    )
    out = ordered(df, ["a", F.desc("key")], totals={"upto": "x"}, lags={"before": "x"}, ranges=16)
    plan = plan_of(out)
    assert "SinglePartition" not in plan
    pdf = out.toPandas().sort_values("position")
    a, key, x = (pdf[c].to_numpy() for c in ("a", "key", "x"))
    assert (pdf.position.to_numpy() == np.arange(1, n + 1)).all()
    order = np.lexsort((-key, a))
    assert (order == np.arange(n)).all()
    assert (pdf.upto.to_numpy() == np.cumsum(x)).all()
    assert (pdf.before.to_numpy() == np.cumsum(x) - x).all()


def test_hot_value_is_split_over_ranges(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("one"))
    out = ordered(df, ["k"], totals={"n": "one"}, ranges=10)
    assert "SinglePartition" not in plan_of(out)
    pdf = out.toPandas().sort_values("position")
    assert (pdf.position == pdf.n).all() and pdf.k.is_monotonic_increasing
    from ridelens.operators.ordered import _ranges

    ranges, _ = _ranges(df, ["k"], 10)
    assert ranges.groupBy("__range").count().agg(F.max("count")).first()[0] < 3 * 30_000 / 10


def test_nulls_doubles_decimals_and_empty_frames(spark):
    df = spark.createDataFrame([(3, None, None), (1, 0.5, 2), (None, 1.5, 3), (2, 0.25, None)], "k int, d double, n int")
    out = ordered(df.withColumn("m", F.col("n").cast("decimal(10,2)")), ["k"], totals={"sd": "d", "sn": "n", "sm": "m"}, lags={"b": "d"}, ranges=3)
    got = sorted((r.position, r.k, r.sd, r.sn, float(r.sm), r.b) for r in out.collect())
    assert got == [(1, None, 1.5, 3, 3.0, 0.0), (2, 1, 2.0, 5, 5.0, 1.5), (3, 2, 2.25, 5, 5.0, 2.0), (4, 3, 2.25, 5, 5.0, 2.25)]
    assert ordered(df.limit(0), ["k"], totals={"s": "n"}).count() == 0


def test_cumulative_with_the_total_before(spark):
    df = spark.createDataFrame([("a", 5), ("b", 2), ("c", 1)], "k string, n long")
    got = {r.k: (r.cum_n, r.ymin) for r in cumulative(df, "n", ["k"], before="ymin").collect()}
    assert got == {"a": (5, 0), "b": (7, 5), "c": (8, 7)}


def test_files_follow_the_order(spark, tmpdir_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    path = os.path.join(tmpdir_path, "ordered")
    back = write_ordered(df, path, [F.desc("k")], ranges=6)
    files = sorted(glob.glob(path + "/part-*.parquet"))
    assert len(files) > 1
    read = [v for f in files for v in pq.read_table(f).column("k").to_pylist()]
    assert read == list(range(4999, -1, -1))
    assert back.where("position = 1").first().k == 4999


def test_top_stations_ranks_by_ranges(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 9), ("d", 1)], "start_station_name string, n_trips long")
    top = top_stations(df)
    assert "SinglePartition" not in plan_of(top)
    assert [(r.start_station_name, r.rank) for r in top.collect()] == [("c", 1), ("a", 2), ("b", 3), ("d", 4)]
    assert [r.rank for r in top_stations(df, 2).collect()] == [1, 2]
