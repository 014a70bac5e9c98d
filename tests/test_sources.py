"""File sources and sinks (S1-S15) on hand-made files."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ridelens.operators.conform import conform_stations
from ridelens.sources import (
    checkpoint_table,
    describe_columns,
    jdbc_options,
    preview,
    read_areas,
    read_stations,
    read_trips,
    write_report,
    write_table,
)

from ridelens.schema import TRIP_FILE_SUFFIX as SUFFIX  # noqa: E402

HEADER = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual\n"


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


@pytest.fixture()
def trip_dir(tmpdir_path):
    _write(
        os.path.join(tmpdir_path, "202401" + SUFFIX),
        HEADER
        + 'A1,electric_bike,2024-01-01 08:00:00.7,2024-01-01 08:10:00,,S1,"",E1,41.8,-87.6,41.9,-87.7,member\n'
        + "A2,NA,2024-01-02 09:00:00,bad-time,Name,NA,End,E2,,-87.6,41.9,-87.7,casual\n",
    )
    _write(
        os.path.join(tmpdir_path, "202501" + SUFFIX),
        HEADER + "B1,classic_bike,2025-01-05 10:00:00,2025-01-05 10:20:00,X,S9,Y,E9,41.8,-87.6,41.9,-87.7,member\n",
    )
    _write(os.path.join(tmpdir_path, "202613" + SUFFIX), HEADER + "C1,x,2026-01-01 00:00:00,,,,,,,,,,\n")
    _write(os.path.join(tmpdir_path, "notes.csv"), "a,b\n1,2\n")
    return tmpdir_path


def test_read_trips_blank_na_and_pattern(spark, trip_dir):
    df = read_trips(spark, trip_dir)
    got = {r.ride_id: r for r in df.collect()}
    assert set(got) == {"A1", "A2", "B1"}  # 2026 does not match the pattern
    a1, a2 = got["A1"], got["A2"]
    # Blank and quoted blank text are '', NA is NULL; blank number is NULL.
    assert (a1.start_station_name, a1.end_station_name) == ("", "")
    assert (a2.rideable_type, a2.start_station_id, a2.start_lat) == (None, None, None)
    assert a2.ended_at is None  # malformed timestamp -> NULL (T16)
    assert a1.started_at == dt.datetime(2024, 1, 1, 8, 0, 0, 700000)
    assert a1.source_month == "202401"
    assert dict(df.dtypes)["started_at"] == "timestamp_ntz"


def test_read_trips_month_range(spark, trip_dir):
    assert [r.ride_id for r in read_trips(spark, trip_dir, months=("202501", "202501")).collect()] == ["B1"]


def test_read_trips_strict_fails(spark, trip_dir):
    with pytest.raises(Exception):
        read_trips(spark, trip_dir, strict=True).collect()


def test_stations_csv(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "stations.csv")
    _write(
        p,
        "ID,Station Name,Short Name,Total Docks,Docks in Service,Status,Latitude,Longitude\n"
        "1,Clark St,CS1,15,15,In Service,41.88,-87.63\n"
        "2,Clark St,CS2,11,10,In Service,41.89,-87.64\n"
        "3,Lake,,9,9,In Service,41.80,-87.60\n",
    )
    st = conform_stations(read_stations(spark, p))
    assert st.columns == ["s_name", "s_id", "lat", "lng"]
    assert st.count() == 3
    assert st.filter(F.col("s_name") == "Lake").first().s_id is None


def test_geojson_areas(spark, tmpdir_path):
    fc = {
        "type": "FeatureCollection",
        "features": [
            {"type": "Feature", "properties": {"community": "A"},
             "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]]}},
            {"type": "Feature", "properties": {"community": "B"},
             "geometry": {"type": "MultiPolygon", "coordinates": [[[[10, 0], [11, 0], [11, 1], [10, 0]]], [[[12, 0], [13, 0], [13, 1], [12, 0]]]]}},
        ],
    }
    p = os.path.join(tmpdir_path, "areas.geojson")
    _write(p, json.dumps(fc, indent=2))
    areas = {r.community: r for r in read_areas(spark, p).collect()}
    assert len(areas["A"].polygon) == 1 and len(areas["A"].polygon[0]) == 2
    assert len(areas["B"].polygon) == 2
    assert (areas["A"].area_id, areas["B"].area_id) == (0, 1)


def test_write_checkpoint_report_describe_preview(spark, tmpdir_path):
    df = spark.createDataFrame([(i, f"m{i % 3}") for i in range(10)], "id int, source_month string")
    out = os.path.join(tmpdir_path, "t")
    write_table(df, out, partition_by=["source_month"])
    assert sorted(d for d in os.listdir(out) if d.startswith("source_month=")) == [
        "source_month=m0",
        "source_month=m1",
        "source_month=m2",
    ]
    ck = checkpoint_table(df, "unit")
    assert ck.count() == 10
    paths = write_report({"a": df, "b": df.limit(1)}, os.path.join(tmpdir_path, "rep"))
    assert spark.read.parquet(paths["b"]).count() == 1
    assert [tuple(r) for r in describe_columns(df).collect()] == [("id", "int"), ("source_month", "string")]
    assert [r.id for r in preview(df, 3, order_by="id").collect()] == [0, 1, 2]


def test_jdbc_options_strip_trailing_comma():
    env = {"DB_NAME": "bikes,", "DB_HOST": "db.example,", "DB_USER": "u", "DB_PSWD": "p,,"}
    o = jdbc_options(env)
    assert o["url"] == "jdbc:mysql://db.example:3306/bikes"
    assert (o["user"], o["password"]) == ("u", "p,")


def test_union_months(spark):
    from ridelens.sources import union_months

    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(1, "x")], "id int, v string")
    out = union_months({"202401": a, "202402": b})
    assert sorted((r.id, r.source_month) for r in out.collect()) == [(1, "202401"), (1, "202402")]
    swapped = spark.createDataFrame([("y", 2)], "v string, id int")
    assert union_months([a, swapped]).count() == 2


def test_malformed_rows_are_set_aside(spark, trip_dir):
    from ridelens.sources import read_trips_checked, reject_counts

    with open(os.path.join(trip_dir, "202501" + SUFFIX), "a") as f:
        f.write("Z1,classic_bike,soon,2025-01-01 08:10:00,A,1,B,2,north,-87.6,41.9,-87.7,member\n")
        f.write("Z2,classic_bike,2025-01-01 08:00:00\n")
        f.write("Z3,classic_bike,2025-01-01 08:00:00,2025-01-01 08:10:00,A,1,B,2,NA,,41.9,-87.7,member,more\n")
    quarantine = os.path.join(tempfile.mkdtemp(prefix="ridelens-test-"), "quarantine")
    good, bad = read_trips_checked(spark, trip_dir, quarantine=quarantine)
    every = read_trips(spark, trip_dir)
    assert good.columns == every.columns and good.dtypes == every.dtypes
    got = {(r.reason, r.value, r.source_month) for r in bad.collect()}
    # 'bad-time' is malformed; blank and NA coordinates are missing, not malformed.
    assert {("started_at,start_lat", "soon", "202501"), ("line", "Z2,classic_bike,2025-01-01 08:00:00", "202501")} <= got
    assert {r[1] for r in got if r[0] == "ended_at"} == {"bad-time"}
    assert {r[0] for r in got} == {"started_at,start_lat", "ended_at", "line"} and len(got) == 4
    assert good.count() + bad.count() == every.count()
    stored = spark.read.parquet(quarantine)
    assert stored.count() == bad.count() and {"source_month", "reason", "value", "ride_id"} <= set(stored.columns)
    counts = reject_counts(good, bad).collect()
    assert sum(r.n_rows for r in counts) == every.count()


def test_unwanted_files_are_not_listed(spark, trip_dir):
    _write(os.path.join(trip_dir, "202401" + SUFFIX + ".bak"), HEADER)
    files = [os.path.basename(f) for f in read_trips(spark, trip_dir, months=("202501", "202512")).inputFiles()]
    assert files == ["202501" + SUFFIX]
    every = sorted(os.path.basename(f) for f in read_trips(spark, trip_dir).inputFiles())
    # The unanchored pattern admits the .bak copy as the reference's would; the
    # 2026 file and notes.csv are never opened.
    assert every == ["202401" + SUFFIX, "202401" + SUFFIX + ".bak", "202501" + SUFFIX]


def test_strict_read_accepts_blank_numbers(spark, tmpdir_path):
    _write(
        os.path.join(tmpdir_path, "202403" + SUFFIX),
        HEADER + "C1,classic_bike,2024-03-01 08:00:00,2024-03-01 08:10:00,A,1,B,2,,-87.6,NA,-87.7,member\n",
    )
    r = read_trips(spark, tmpdir_path, strict=True).first()
    assert (r.start_lat, r.end_lat, r.start_lng) == (None, None, -87.6)
