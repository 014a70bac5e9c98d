"""Station conformance, audits and canonical ids (J5-J7, A16-A21; T5, T14, T15)."""

from pyspark.sql import functions as F

from conftest import plan_of
from ridelens.operators.conform import (
    arg_max,
    arg_min,
    canonical_id,
    canonical_name,
    conflict_audit,
    conform_station,
    conform_stations,
    distinct_count,
    pair_counts,
    unique_stations,
)

TRIPS = "start_station_name string, start_station_id string, start_lat double, start_lng double, x int"


def _stations(spark, rows):
    return spark.createDataFrame(rows, "s_name string, s_id string, lat float, lng float")


def test_conform_overwrites_even_with_null(spark):
    trips = spark.createDataFrame(
        [("A", "old", 1.0, 1.0, 1), ("B", "oldB", 2.0, 2.0, 2), ("", "x", 3.0, 3.0, 3), (None, "y", 4.0, 4.0, 4)], TRIPS
    )
    st = _stations(spark, [("A", None, 10.0, 20.0), ("B", "SB", None, 21.0)])
    out = {r.x: r for r in conform_station(trips, st).collect()}
    assert (out[1].start_station_id, out[1].start_lat, out[1].start_lng) == (None, 10.0, 20.0)  # T5
    assert (out[2].start_station_id, out[2].start_lat) == ("SB", None)
    assert (out[3].start_station_id, out[3].start_lat) == ("x", 3.0)
    assert (out[4].start_station_name, out[4].start_station_id) == (None, "y")
    assert conform_station(trips, st).count() == 4


def test_conform_broadcasts_dimension(spark):
    trips = spark.createDataFrame([("A", "1", 1.0, 1.0, 1)], TRIPS)
    st = _stations(spark, [("A", "S", 1.0, 1.0)])
    assert "BroadcastHashJoin" in plan_of(conform_station(trips, st))


def test_unique_stations_rule(spark):
    st = _stations(spark, [("A", "S2", 1.0, 1.0), ("A", "S1", 2.0, 2.0), ("B", "S3", 1.0, 1.0), ("B", None, 5.0, 5.0)])
    out = {r.s_name: (r.s_id, r.lat) for r in unique_stations(st).collect()}
    assert out == {"A": ("S1", 2.0), "B": (None, 5.0)}


def test_conform_stations_columns(spark):
    raw = spark.createDataFrame(
        [("1", "A", "S1", 10, 9, "In Service", 41.5, -87.5, "extra")],
        "`ID` string, `Station Name` string, `Short Name` string, `Total Docks` int, `Docks in Service` int, "
        "`Status` string, `Latitude` double, `Longitude` double, other string",
    )
    out = conform_stations(raw)
    assert out.dtypes == [("s_name", "string"), ("s_id", "string"), ("lat", "float"), ("lng", "float"), ("other", "string")]


def test_arg_max_min_first_on_tie(spark):
    df = spark.createDataFrame([("k", "b", 5), ("k", "a", 5), ("k", "c", 1), ("k", None, 1)], "k string, v string, n long")
    r = df.groupBy("k").agg(arg_max("v", "n").alias("most"), arg_min("v", "n").alias("least")).first()
    assert (r.most, r.least) == ("a", None)


def test_distinct_count_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), ("b",)], "v string")
    r = df.agg(distinct_count("v").alias("sql"), distinct_count("v", count_null=True).alias("r")).first()
    assert (r.sql, r.r) == (2, 3)


def test_conflict_audit(spark):
    df = spark.createDataFrame(
        [("N1", "i1"), ("N1", "i1"), ("N1", "i2"), ("N2", "i3"), ("N3", None), ("N3", "i4")], "name string, id string"
    )
    out = {r.name: r for r in conflict_audit(df, "name", "id", "id").collect()}
    assert set(out) == {"N1", "N3"}
    assert (out["N1"].n_distinct_ids, out["N1"].most_popular_id, out["N1"].less_popular_id) == (2, "i1", "i2")
    assert (out["N3"].n_distinct_ids, out["N3"].most_popular_id) == (2, None)
    detail = conflict_audit(df, "name", "id", "id", detail=True)
    assert detail.filter(F.col("name") == "N1").count() == 2
    assert pair_counts(df, "name", "id").count() == 5


def test_canonical_id_max_and_mode(spark):
    df = spark.createDataFrame(
        [("N", "a", 1), ("N", "a", 2), ("N", "b", 3), ("N", None, 4), (None, "z", 5), ("M", None, 6)],
        "start_station_name string, start_station_id string, x int",
    )
    mx = {r.x: r.start_station_id for r in canonical_id(df).collect()}
    assert mx == {1: "b", 2: "b", 3: "b", 4: None, 5: "z", 6: None}
    mode = {r.x: r.start_station_id for r in canonical_id(df, strategy="mode").collect()}
    assert mode == {1: "a", 2: "a", 3: "a", 4: None, 5: "z", 6: None}
    again = canonical_id(canonical_id(df))
    assert sorted(r.start_station_id or "" for r in again.collect()) == sorted(v or "" for v in mx.values())
    # After the fix no name has two ids (NULL ids aside).
    assert conflict_audit(canonical_id(df).dropna(subset=["start_station_id"]), "start_station_name", "start_station_id", "id").count() == 0


def test_canonical_name_with_exclusion(spark):
    df = spark.createDataFrame(
        [("Public Rack - X", "i1", 1), ("Station X", "i1", 2), ("Z (TEMPORARY)", "i2", 3), ("A", "i2", 4)],
        "start_station_name string, start_station_id string, x int",
    )
    out = {r.x: r.start_station_name for r in canonical_name(df, exclude=["Public Rack%", "%TEMPORARY)"]).collect()}
    assert out == {1: "Station X", 2: "Station X", 3: "A", 4: "A"}


def test_canonical_id_collation(spark):
    df = spark.createDataFrame(
        [("Clark St", "a", 1), ("CLARK ST", "b", 2)], "start_station_name string, start_station_id string, x int"
    )
    binary = {r.x: r.start_station_id for r in canonical_id(df).collect()}
    ci = {r.x: r.start_station_id for r in canonical_id(df, collation="UTF8_LCASE").collect()}
    assert binary == {1: "a", 2: "b"}
    assert ci == {1: "b", 2: "b"}


def test_conform_station_collation(spark):
    trips = spark.createDataFrame([("CLARK ST", "old", 1.0, 1.0, 1), ("Lake", "l", 2.0, 2.0, 2)], TRIPS)
    st = _stations(spark, [("Clark St", "CS", 10.0, 20.0)])
    binary = {r.x: r.start_station_id for r in conform_station(trips, st).collect()}
    ci = {r.x: (r.start_station_name, r.start_station_id) for r in conform_station(trips, st, collation="UTF8_LCASE").collect()}
    assert binary == {1: "old", 2: "l"}
    assert ci == {1: ("Clark St", "CS"), 2: ("Lake", "l")}


def test_conform_collation_does_not_fan_out(spark):
    trips = spark.createDataFrame([("clark st", "old", 1.0, 1.0, 1)], TRIPS)
    st = _stations(spark, [("Clark St", "CS", 10.0, 20.0), ("CLARK ST", "CS2", 11.0, 21.0)])
    out = conform_station(trips, st, collation="UTF8_LCASE").collect()
    assert len(out) == 1 and out[0].start_station_id == "CS"


def test_salted_canonical_id_equals_plain(spark):
    rows = [("N", "a", i) for i in range(200)] + [("N", "b", 1000), ("M", None, 1001), (None, "z", 1002)]
    df = spark.createDataFrame(rows, "start_station_name string, start_station_id string, x int")
    plain = sorted((r.x, r.start_station_id) for r in canonical_id(df).collect())
    salted = sorted((r.x, r.start_station_id) for r in canonical_id(df, salt_buckets=5).collect())
    assert plain == salted


def test_conform_without_broadcast_equals_broadcast(spark):
    trips = spark.createDataFrame(
        [("A", "old", 1.0, 1.0, 1), ("B", "oldB", 2.0, 2.0, 2), ("", "x", 3.0, 3.0, 3)], TRIPS
    )
    st = _stations(spark, [("A", None, 10.0, 20.0), ("B", "SB", None, 21.0)])
    a = sorted(tuple(r) for r in conform_station(trips, st).collect())
    b = sorted(tuple(r) for r in conform_station(trips, st, max_broadcast_rows=0).collect())
    assert a == b


def test_salted_conform_equals_plain(spark):
    trips = spark.createDataFrame(
        [("A", "old", 1.0, 1.0, i) for i in range(50)] + [("B", "oldB", 2.0, 2.0, 99), (None, "n", 0.0, 0.0, 100)], TRIPS
    )
    st = _stations(spark, [("A", None, 10.0, 20.0), ("B", "SB", None, 21.0)])
    key = lambda t: tuple((v is None, repr(v)) for v in t)
    a = sorted((tuple(r) for r in conform_station(trips, st, max_broadcast_rows=0).collect()), key=key)
    b = sorted((tuple(r) for r in conform_station(trips, st, max_broadcast_rows=0, salt_buckets=4).collect()), key=key)
    assert a == b and len(a) == 52
