"""Rollups and shares (A4-A15, A24, W1-W6) with their invariants."""

import pytest
from pyspark.sql import functions as F

from ridelens.operators.rollup import (
    avg_duration,
    frequency,
    od_rollup,
    station_trips,
    time_rollup,
    time_rollup_legacy,
    top_stations,
    usage_by,
)
from ridelens.operators.share import cumulative, share_of_total, share_segments, share_within

RIDES = (
    "member boolean, rideable_type tinyint, duration int, year smallint, month tinyint, weekday tinyint, hour tinyint, "
    "start_station_name string, end_station_name string, start_lat float, start_lng float, end_lat float, end_lng float"
)


@pytest.fixture()
def rides(spark):
    data = []
    for i in range(60):
        data.append(
            (i % 2 == 0, i % 3 + 1, 2 + i % 7, 2024 + (i % 13) // 12, (i % 13) % 12 + 1, i % 7 + 1, i % 24,
             f"S{i % 4}", f"S{i % 5}", 41.0 + i % 4, -87.0, 41.5, -87.5)
        )
    return spark.createDataFrame(data, RIDES)


def test_time_rollup_totals(spark, rides):
    tr = time_rollup(rides)
    agg = tr.agg(F.sum("n_trips").alias("n"), F.sum("duration").alias("d")).first()
    raw = rides.agg(F.count("*").alias("n"), F.sum("duration").alias("d")).first()
    assert (agg.n, agg.d) == (raw.n, raw.d)
    r = tr.first()
    assert r.avg_duration == pytest.approx(r.duration / r.n_trips)
    ordered = time_rollup(rides, ordered=True).collect()
    keys = [(r.year, r.month, r.weekday, r.hour, r.type) for r in ordered]
    assert keys == sorted(keys)


def test_usage_frames_sum_to_rides(spark, rides):
    tr = time_rollup(rides)
    for keys in (["date"], ["weekday"], ["hour"], ["date", "weekday", "hour"]):
        assert usage_by(tr, keys).agg(F.sum("n")).first()[0] == 60
    monthly = usage_by(tr, ["date"])
    assert monthly.filter(F.col("date").isNull()).count() == 0
    assert set(r.date for r in monthly.collect()) >= {"Jan.2024", "Jan.2025"}


def test_share_within_sums_to_100(spark, rides):
    monthly = usage_by(time_rollup(rides), ["date"])
    raw = share_within(monthly, "n", ["date", "member"], digits=None)
    for r in raw.groupBy("date", "member").agg(F.sum("percentage").alias("p")).collect():
        assert r.p == pytest.approx(100.0)


def test_share_of_total_and_cumulative(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n_trips long")
    s = share_of_total(df)
    assert s.agg(F.sum("percent")).first()[0] == pytest.approx(100.0)
    c = cumulative(s, "percent", [F.col("k")]).orderBy("k").collect()
    assert [r.cum_percent for r in c] == [pytest.approx(25.0), pytest.approx(100.0)]


def test_share_segments(spark):
    rows = [("member", "electric_bike")] * 3 + [("casual", "classic_bike")] * 1 + [("casual", "unknown")] * 4
    df = spark.createDataFrame(rows, "member_casual string, rideable_type string")
    out = share_segments(df).orderBy("position").collect()
    assert [r.type for r in out] == ["M-Electric Bike", "C-Classic Bike", None]
    assert out[-1].ymax == pytest.approx(100.0)
    assert out[0].ymin == 0.0 and out[1].ymin == pytest.approx(out[0].ymax)
    assert out[0].label == "M-Electric Bike\n37.5 %"


def test_od_station_frequency(spark, rides):
    od = od_rollup(rides)
    assert od.agg(F.sum("n_trips")).first()[0] == 60
    st = station_trips(rides)
    assert st.agg(F.sum("n_trips")).first()[0] == 60
    top = top_stations(st, 2).collect()
    assert len(top) == 2 and top[0].n_trips >= top[1].n_trips
    fr = frequency(rides)
    assert fr.agg(F.sum("n_trips")).first()[0] == 60
    assert set(fr.columns) >= {"member_label", "bike_label"}


def test_station_trips_na_rm(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0), ("A", None, 3.0), ("", 1.0, 1.0)], "start_station_name string, start_lng double, start_lat double")
    keep = {r.start_station_name: r for r in station_trips(df, na_rm=False).collect()}
    assert set(keep) == {"A"} and keep["A"].lng is None and keep["A"].lat == pytest.approx(2.5)


def test_avg_duration_modes(spark, rides):
    tr = time_rollup(rides)
    assert avg_duration(tr, "row").count() == tr.count()
    w = avg_duration(tr, "weighted")
    tot = w.agg(F.sum("n_trips")).first()[0]
    assert tot == 60


def test_time_rollup_legacy_levels(spark):
    df = spark.createDataFrame(
        [(2024, "Feb", "Sun", 8, "classic_bike", "member", 60), (2024, "Jan", "Mon", 8, "classic_bike", "member", 30)],
        "year int, month string, day_of_week string, hour_of_day int, rideable_type string, member_casual string, trip_duration int",
    )
    out = time_rollup_legacy(df, ordered=True).collect()
    assert [(r.month, r.month_level, r.weekday_level) for r in out] == [("Jan", 1, 1), ("Feb", 2, 7)]


def test_time_rollup_scale(spark, rides):
    r = time_rollup(rides, scale=4).collect()
    for row in r:
        assert row.avg_duration == pytest.approx(round(row.duration / row.n_trips, 4))


def test_cluster_conf():
    from ridelens.session import cluster_conf

    c = cluster_conf(100 * 1024**4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(10, 8)["spark.sql.shuffle.partitions"] == "16"


def test_usage_frames_equal_the_frames_one_by_one(spark):
    from conftest import plan_of, rows
    from ridelens.operators.rollup import USAGE_FRAMES, usage_by, usage_frames

    data = [(2024, m, w, h, b, k, 1 + m + h) for m in (1, 2) for w in (1, 7) for h in (0, 23) for b in (True, False) for k in (1, 3)]
    data += [(2030, 5, 1, 0, None, 1, 9)]  # a month without a label, a NULL of the data
    rollup = spark.createDataFrame(data, "year int, month int, weekday int, hour int, member boolean, rideable_type int, n_trips long")
    out = usage_frames(rollup)
    assert plan_of(out).count("Scan ExistingRDD") <= 2  # one node, named twice in the plan's text
    keys = {"monthly": ["date"], "weekday": ["weekday"], "hour": ["hour"], "heatmap": ["date", "weekday", "hour"], "frequency": []}
    for name, columns in USAGE_FRAMES.items():
        by = ["member"] if name == "heatmap" else ["member", "rideable_type"]
        want = usage_by(rollup, keys[name], by=by)
        got = out.where(out.frame == name).select(*want.columns)
        key = lambda t: tuple((v is None, v) for v in t)
        assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((tuple(r) for r in want.collect()), key=key)
    assert out.where("frame IS NULL").count() == 0 and rows(out.select("frame").distinct()) == [(n,) for n in sorted(USAGE_FRAMES)]
