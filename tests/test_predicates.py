"""Three-valued deletes and the main clean."""

import datetime as dt

from pyspark.sql import functions as F

from ridelens.operators.clean import clean_trips
from ridelens.operators.predicates import (
    delete_where,
    drop_both_blank,
    drop_longer_than,
    drop_non_positive_span,
    drop_shorter_than,
    duration_between,
    exclude_like,
    min_trips,
)


def test_delete_where_keeps_null_predicate(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "")], "id int, name string")
    out = delete_where(df, F.col("name") == "")
    assert sorted(r.id for r in out.collect()) == [1, 2]
    # The naive form drops the NULL row.
    assert sorted(r.id for r in df.filter(~(F.col("name") == "")).collect()) == [2]


def test_equals_null_pair_removes_nothing(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", ""), (3, "", None)], "id int, a string, b string")
    pred = ((F.col("a") == F.lit(None)) & (F.col("b") == F.lit(None))) | ((F.col("a") == "") & (F.col("b") == ""))
    assert sorted(r.id for r in delete_where(df, pred).collect()) == [1, 3]


def test_disjuncts_equal_single_predicate(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 0), (4, -1)], "id int, x int")
    p1, p2 = F.col("x") > 3, F.col("x") < 0
    a = sorted(r.id for r in delete_where(df, p1 | p2).collect())
    b = sorted(r.id for r in delete_where(df, p1, p2).collect())
    assert a == b == [1, 3]


def test_one_blank_name_is_kept(spark):
    df = spark.createDataFrame(
        [(1, "", ""), (2, "", "x"), (3, "x", ""), (4, None, "")], "id int, start_station_name string, end_station_name string"
    )
    assert sorted(r.id for r in drop_both_blank(df).collect()) == [2, 3, 4]


def _span(spark, pairs):
    base = dt.datetime(2024, 1, 1)
    data = [(i, base, None if s is None else base + dt.timedelta(seconds=s)) for i, s in enumerate(pairs)]
    return spark.createDataFrame(data, "id int, started_at timestamp_ntz, ended_at timestamp_ntz")


def test_duration_window_boundaries(spark):
    # 119 s = 1 whole minute (deleted); 120 s = 2 (kept); 210 min kept; 211 deleted; NULL kept.
    df = _span(spark, [119, 120, 210 * 60 + 59, 211 * 60, None, -300])
    kept = sorted(r.id for r in duration_between(df).collect())
    assert kept == [1, 2, 4]


def test_span_rules(spark):
    df = _span(spark, [0, -5, 59, 60, 86400, 86401, None])
    out = drop_shorter_than(drop_longer_than(drop_non_positive_span(df), 86400), 60)
    assert sorted(r.id for r in out.collect()) == [3, 4, 6]


def test_exclude_like_any_all(spark):
    names = ["Public Rack - A", "Public Rack - B (TEMPORARY)", "C (TEMPORARY)", "D", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    pats = ["Public Rack%", "%TEMPORARY)"]
    all_ = sorted(r.name for r in exclude_like(df, "name", pats, how="all").collect())
    any_ = sorted(r.name for r in exclude_like(df, "name", pats, how="any").collect())
    assert all_ == ["D"]
    # OR of two NOT LIKEs drops a name only when it matches both (D16); NULL dropped.
    assert any_ == ["C (TEMPORARY)", "D", "Public Rack - A"]


def test_min_trips(spark):
    df = spark.createDataFrame([(0,), (1,), (5,)], "n_trips int")
    assert [r.n_trips for r in min_trips(df, 0).collect()] == [1, 5]


def test_clean_trips_rules(spark):
    base = dt.datetime(2024, 1, 1, 8)
    end = base + dt.timedelta(minutes=10)
    good = ("r1", "classic_bike", base, end, "A", "1", "B", "2", 41.0, -87.0, 41.1, -87.1, "member")
    rows = [
        good,
        ("r2", None, base, end, "A", "1", "B", "2", 41.0, -87.0, 41.1, -87.1, "member"),
        ("r3", "classic_bike", base, end, "", "1", "", "2", 41.0, -87.0, 41.1, -87.1, "member"),
        ("r4", "classic_bike", base, end, None, "1", None, "2", 41.0, -87.0, 41.1, -87.1, "member"),
        ("r5", "classic_bike", base, base + dt.timedelta(seconds=90), "A", "1", "B", "2", 41.0, -87.0, 41.1, -87.1, ""),
        ("r6", "classic_bike", base, end, "A", "1", "B", "2", 41.0, -87.0, None, -87.1, "casual"),
        ("r7", "", base, end, "A", None, "", "2", 41.0, -87.0, 41.1, -87.1, ""),
    ]
    schema = (
        "ride_id string, rideable_type string, started_at timestamp_ntz, ended_at timestamp_ntz, "
        "start_station_name string, start_station_id string, end_station_name string, end_station_id string, "
        "start_lat double, start_lng double, end_lat double, end_lng double, member_casual string"
    )
    out = clean_trips(spark.createDataFrame(rows, schema))
    # Blank (not NULL) bike type and member pass, as in the reference (T2);
    # both names NULL is not caught by '= NULL' (D1).
    assert sorted(r.ride_id for r in out.collect()) == ["r1", "r4", "r7"]
