"""Degenerate inputs: empty table, one row, all-NULL group."""

import pytest

from ridelens.operators.clean import drop_all_duplicates, null_audit
from ridelens.operators.conform import conflict_audit, canonical_id
from ridelens.operators.distribution import boxplot_stats, histogram
from ridelens.operators.geo import area_totals, within_join
from ridelens.operators.outliers import drop_zscore
from ridelens.operators.rollup import station_trips, time_rollup, usage_by
from ridelens.operators.share import share_within

RIDES = (
    "member boolean, rideable_type tinyint, duration int, year smallint, month tinyint, weekday tinyint, hour tinyint, "
    "start_station_name string, start_station_id string, start_lat float, start_lng float"
)
AREAS = "area_id long, community string, polygon array<array<array<array<double>>>>"


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], RIDES)


@pytest.fixture()
def one(spark):
    return spark.createDataFrame([(True, 1, 12, 2024, 5, 2, 8, "A", "a", 41.5, -87.5)], RIDES)


def test_empty_table(spark, empty):
    assert time_rollup(empty).count() == 0
    assert usage_by(time_rollup(empty), ["date"]).count() == 0
    assert histogram(empty, "duration", 2.0, by=["member"]).count() == 0
    assert boxplot_stats(empty, "duration", ["member"]).count() == 0
    assert drop_zscore(empty, "duration").count() == 0
    assert drop_all_duplicates(empty, ["start_station_name"]).count() == 0
    assert station_trips(empty).count() == 0
    assert conflict_audit(empty, "start_station_name", "start_station_id", "id").count() == 0
    assert canonical_id(empty).count() == 0
    r = null_audit(empty, ["duration"]).first()
    assert r.duration_nulls is None
    areas = spark.createDataFrame([(0, "A", [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]])], AREAS)
    pts = spark.createDataFrame([], "lng double, lat double, n_trips long")
    assert within_join(pts, areas).count() == 0
    assert [(r.community, r.n_trips) for r in area_totals(pts, areas).collect()] == [("A", 0)]


def test_one_row(spark, one):
    # Population SD of one value is 0: the SQL form keeps the row; the sample
    # SD is NULL, so the R form drops it.
    assert drop_zscore(one, "duration").count() == 1
    assert drop_zscore(one, "duration", sd="samp", strict=True).count() == 0
    b = boxplot_stats(one, "duration", ["member"]).first()
    assert (b.lower, b.middle, b.upper, b.ymin, b.ymax, b.n_outliers) == (12.0, 12.0, 12.0, 12.0, 12.0, 0)
    h = histogram(one, "duration", 2.0).first()
    assert (h.bin, h.n) == (12.0, 1)
    t = time_rollup(one).first()
    assert (t.n_trips, t.duration, t.avg_duration) == (1, 12, 12.0)


def test_all_null_group(spark):
    df = spark.createDataFrame(
        [("A", None, None, None), ("A", None, None, None), ("B", "b", 1.0, 2.0)],
        "start_station_name string, start_station_id string, start_lng double, start_lat double",
    )
    st = {r.start_station_name: r for r in station_trips(df).collect()}
    assert st["A"].n_trips == 2 and st["A"].lng is None
    audit = conflict_audit(df, "start_station_name", "start_station_id", "id")
    assert audit.count() == 0  # a single (NULL) id is one distinct value
    shares = share_within(spark.createDataFrame([("x", 0), ("x", 0)], "g string, n long"), "n", ["g"])
    assert [r.percentage for r in shares.collect()] == [None, None]  # 0 / 0 is NULL, not an error
