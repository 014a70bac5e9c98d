"""States and sketches by month, and the reload of one month."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ridelens.operators.monthly import (
    HLL_BOUND,
    KLL_BOUND,
    merged_sketches,
    merged_stats,
    merged_time_rollup,
    month_sketches,
    replace_months,
    time_state,
)
from ridelens.operators.outliers import drop_zscore, zscore_stats
from ridelens.operators.rollup import time_rollup

MONTHS = ["202401", "202402", "202403"]


def rides(spark, n=4000):
    e = F.col("id")
    return spark.range(n).select(
        F.element_at(F.array(*map(F.lit, MONTHS)), (e % 3 + 1).cast("int")).alias("source_month"),
        F.lit(2024).alias("year"), (e % 3 + 1).cast("int").alias("month"), (e % 7 + 1).cast("int").alias("weekday"),
        (e % 24).cast("int").alias("hour"), (e % 2 == 0).alias("member"), (e % 3 + 1).cast("int").alias("rideable_type"),
        F.when(e % 251 == 0, 200).when(e % 97 != 0, F.pmod(F.xxhash64("id"), F.lit(30)).cast("int") + 2).alias("duration"),
        F.concat(F.lit("S"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(700)).cast("string")).alias("start_station_name"),
    )


def files(path, month):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/source_month={month}/*.parquet")}


def test_merged_months_equal_the_whole_after_adding_and_replacing(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "state")
    whole = rides(spark)
    replace_months(time_state(whole.where("source_month = '202401'")), path, ["202401"])
    replace_months(time_state(whole.where("source_month = '202402' AND hour < 5")), path, ["202402"])
    replace_months(time_state(whole.where("source_month = '202403'")), path, ["202403"])
    kept = files(path, "202401"), files(path, "202403")
    replace_months(time_state(whole.where("source_month = '202402'")), path, ["202402"])
    assert (files(path, "202401"), files(path, "202403")) == kept
    state = spark.read.schema(time_state(whole).schema).parquet(path)
    want = time_rollup(drop_zscore(whole, "duration"))
    assert rows(merged_time_rollup(state)) == rows(want) and want.count() > 0
    assert want.agg(F.sum("n_trips")).first()[0] < whole.count()  # the cut removes some
    a, b = merged_stats(state).first(), zscore_stats(whole, "duration").first()
    assert abs(a.mean - b["__mean"]) < 1e-12 * b["__mean"] and abs(a.sd - b["__sd"]) < 1e-9


def test_failed_load_leaves_the_old_month(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "table")
    whole = rides(spark, 300).select("source_month", "duration", "hour")
    replace_months(whole, path, MONTHS)
    before = [files(path, m) for m in MONTHS]
    boom = F.when(F.col("hour") > 20, F.raise_error(F.lit("boom")).cast("int")).otherwise(F.col("duration"))
    with pytest.raises(Exception, match="boom"):
        replace_months(whole.where("source_month = '202402'").withColumn("duration", boom), path, ["202402"])
    assert [files(path, m) for m in MONTHS] == before
    with pytest.raises(ValueError, match="outside"):
        replace_months(whole, path, ["202402"])
    assert [files(path, m) for m in MONTHS] == before


def test_a_month_without_rows_becomes_empty(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "table")
    whole = rides(spark, 300).select("source_month", "duration")
    replace_months(whole, path, MONTHS)
    replace_months(whole.limit(0), path, ["202402"])
    left = spark.read.schema(whole.schema).parquet(path)
    assert {r[0] for r in left.select("source_month").distinct().collect()} == {"202401", "202403"}


def test_merged_sketches_are_within_their_bounds(spark):
    whole = rides(spark, 30_000)
    got = {r.member: r for r in merged_sketches(month_sketches(whole, ["member"], "start_station_name", "duration"), ["member"]).collect()}
    for member in (True, False):
        own = whole.where(F.col("member") == member)
        exact = own.select("start_station_name").distinct().count()
        assert abs(got[member].n_distinct - exact) <= HLL_BOUND * exact
        assert got[member].n == own.count()
        values = sorted(r[0] for r in own.where("duration IS NOT NULL").select("duration").collect())
        for q in (25, 50, 75):
            x = got[member][f"q{q}"]
            below, upto = sum(v < x for v in values) / len(values), sum(v <= x for v in values) / len(values)
            assert below - KLL_BOUND <= q / 100 <= upto + KLL_BOUND
