"""Scalar functions and derivation (P2-P17, E1-E8, traps T7, T9, T16)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ridelens.functions.scalar import (
    bike_code,
    bike_label,
    haversine_m,
    member_flag,
    member_label,
    minutes_between,
    month_label,
    segment_label,
    segment_label_raw,
    to_minutes,
    weekday_order,
)
from ridelens.operators.derive import derive_rides, derive_rides_legacy, narrow, type_timestamps, type_trips
from ridelens.schema import EARTH_RADIUS_M


def test_member_flag_and_codes(spark):
    df = spark.createDataFrame([("member", "electric_bike"), ("casual", "classic_bike"), (None, None), ("", "other")], "m string, b string")
    out = df.select(member_flag("m").alias("f"), bike_code("b").alias("c")).collect()
    assert [(r.f, r.c) for r in out] == [(True, 1), (False, 2), (False, 3), (False, 3)]


def test_labels(spark):
    df = spark.createDataFrame([(True, 1), (False, 2), (False, 3), (None, 4), (True, None)], "m boolean, c int")
    out = df.select(
        member_label("m").alias("ml"), bike_label("c").alias("bl"), segment_label("m", "c").alias("seg")
    ).collect()
    assert [r.ml for r in out] == ["Member", "Casual", "Casual", None, "Member"]
    assert [r.bl for r in out] == ["Electric Bike", "Classic Bike", "Electric Scooter", None, None]
    # The final ELSE catches NULLs and unknown codes.
    assert [r.seg for r in out] == ["M-Electric Bike", "C-Classic Bike", "C-Electric Scooter", "C-Electric Scooter", "C-Electric Scooter"]


def test_segment_label_raw(spark):
    df = spark.createDataFrame([("member", "electric_scooter"), ("casual", "classic_bike"), ("x", "classic_bike")], "m string, b string")
    assert [r.s for r in df.select(segment_label_raw("m", "b").alias("s")).collect()] == [
        "M-Electric Scooter",
        "C-Classic Bike",
        None,
    ]


def test_month_label_levels(spark):
    df = spark.createDataFrame([(2024, 1), (2024, 12), (2025, 1), (2025, 2), (2023, 12)], "y int, m int")
    assert [r.l for r in df.select(month_label("y", "m").alias("l")).collect()] == [
        "Jan.2024",
        "Dec.2024",
        "Jan.2025",
        None,
        None,
    ]


def test_weekday_order(spark):
    df = spark.createDataFrame([(d,) for d in range(1, 8)], "d int")
    assert [r.o for r in df.select(weekday_order("d").alias("o")).collect()] == [7, 1, 2, 3, 4, 5, 6]


def test_minutes_truncate_toward_zero(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(base, base + dt.timedelta(seconds=119)), (base + dt.timedelta(seconds=119), base), (base, None)],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r.m for r in df.select(minutes_between("a", "b").alias("m")).collect()] == [1, -1, None]


def test_minutes_ignore_session_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-03-10 01:30:00' a, timestamp_ntz'2024-03-10 03:10:00' b")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
        assert df.select(minutes_between("a", "b").alias("m")).first().m == 100
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_to_minutes_rounding(spark):
    df = spark.createDataFrame([(150,), (210,), (90,), (89,)], "s int")
    out = df.select(to_minutes("s", "half_even").alias("e"), to_minutes("s", "half_up").alias("u")).collect()
    # 2.5 -> 2 (R) / 3 (SQL); 3.5 -> 4 / 4; 1.5 -> 2 / 2.
    assert [(r.e, r.u) for r in out] == [(2.0, 3.0), (4.0, 4.0), (2.0, 2.0), (1.0, 1.0)]


def test_haversine_properties(spark):
    df = spark.createDataFrame([(-87.6, 41.8, -87.6, 42.8), (-87.6, 41.8, -87.6, 41.8), (-87.6, 41.8, -87.7, 41.9)], "a double, b double, c double, d double")
    out = df.select(
        haversine_m("a", "b", "c", "d").alias("ab"), haversine_m("c", "d", "a", "b").alias("ba")
    ).collect()
    assert out[0].ab == pytest.approx(EARTH_RADIUS_M * math.pi / 180, rel=1e-12)
    assert out[1].ab == 0.0
    assert out[2].ab == pytest.approx(out[2].ba, abs=1e-6)


def test_haversine_strict_rejects_bad_coordinates(spark):
    df = spark.createDataFrame([(-87.6, 141.8, -87.6, 42.8)], "a double, b double, c double, d double")
    with pytest.raises(Exception):
        df.select(haversine_m("a", "b", "c", "d", strict=True).alias("x")).collect()


def test_type_timestamps_permissive_and_strict(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00.6", "bad")], "started_at string, ended_at string")
    r = type_timestamps(df, to_second=False).first()
    assert r.started_at == dt.datetime(2024, 1, 1, 10, 0, 0, 600000) and r.ended_at is None
    r2 = type_timestamps(df.select("started_at", F.col("started_at").alias("ended_at")), to_second=True).first()
    assert r2 == type_timestamps(df.select("started_at", F.col("started_at").alias("ended_at"))).first()
    assert r2.started_at == dt.datetime(2024, 1, 1, 10, 0, 1)  # DATETIME rounds (T9)
    with pytest.raises(Exception):
        type_timestamps(df, strict=True).collect()


def test_narrow_checks(spark):
    ok = spark.createDataFrame([(5, "abc")], "hour int, start_station_name string")
    assert narrow(ok).dtypes == [("hour", "tinyint"), ("start_station_name", "string")]
    with pytest.raises(Exception):
        narrow(spark.createDataFrame([(200, "a")], "hour int, start_station_name string")).collect()
    with pytest.raises(Exception):
        narrow(spark.createDataFrame([(1, "x" * 65)], "hour int, start_station_name string")).collect()


def test_type_trips_drops_row_names(spark):
    df = spark.createDataFrame([(1, "r", 41.5)], "row_names long, ride_id string, start_lat double")
    out = type_trips(df)
    assert out.dtypes == [("ride_id", "string"), ("start_lat", "float")]


def _trip(spark, minutes=10):
    base = dt.datetime(2024, 3, 3, 8, 15)  # a Sunday
    row = ("r1", "electric_bike", base, base + dt.timedelta(minutes=minutes, seconds=30), "A", "1", "B", "2", 41.0, -87.0, 41.0, -87.0, "member")
    schema = (
        "ride_id string, rideable_type string, started_at timestamp_ntz, ended_at timestamp_ntz, "
        "start_station_name string, start_station_id string, end_station_name string, end_station_id string, "
        "start_lat double, start_lng double, end_lat double, end_lng double, member_casual string"
    )
    return spark.createDataFrame([row], schema)


def test_derive_rides(spark):
    r = narrow(derive_rides(_trip(spark))).first()
    assert (r.member, r.rideable_type, r.duration, r.distance, r.hour, r.weekday, r.month, r.year) == (
        True, 1, 10, 0, 8, 1, 3, 2024,
    )


def test_derive_rides_legacy(spark):
    r = derive_rides_legacy(_trip(spark)).first()
    assert (r.trip_duration, r.hour_of_day, r.day_of_week, r.month, r.year) == (630, 8, "Sun", "Mar", 2024)


def test_exact_ratio_rounds_once(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from ridelens.functions.scalar import exact_ratio

    pairs = [(7, 3), (1, 8), (5, 2), (-5, 2), (233335, 100000), (2**60, 3), (1, 0), (None, 2)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r.q for r in df.select(exact_ratio("a", "b", 4).alias("q")).collect()]
    for (a, b), q in zip(pairs, got):
        if a is None or b == 0:
            assert q is None
            continue
        exp = (Decimal(abs(a)) / Decimal(b)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)
        assert q == float(exp if a >= 0 else -exp)


def test_narrow_checks_without_ansi(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        with pytest.raises(Exception):
            narrow(spark.createDataFrame([(300, "a")], "hour int, start_station_name string")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_round_to_second_is_zone_free(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-03-10 02:30:59.6' as started_at, timestamp_ntz'2024-12-31 23:59:59.5' as ended_at"
    )
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Chicago"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = type_timestamps(df, to_second=True).first()
            assert r.started_at == dt.datetime(2024, 3, 10, 2, 31, 0)
            assert r.ended_at == dt.datetime(2025, 1, 1, 0, 0, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
