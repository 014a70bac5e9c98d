"""Incremental load of monthly files with Structured Streaming."""

import os

import pytest

from ridelens.streaming import ingest_trip_files

from ridelens.schema import TRIP_FILE_SUFFIX as SUFFIX  # noqa: E402

HEADER = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual\n"


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_ingest_is_exactly_once(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    out = os.path.join(tmpdir_path, "out")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    os.makedirs(src)
    _write(os.path.join(src, "202401" + SUFFIX), HEADER + "A,electric_bike,2024-01-01 08:00:00,2024-01-01 08:10:00,S,1,E,2,41.8,-87.6,41.9,-87.7,member\n")
    _write(os.path.join(src, "README.csv"), "x\n1\n")
    q = ingest_trip_files(spark, src, out, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 1
    # A new month arrives; a rerun loads only the new file.
    _write(os.path.join(src, "202402" + SUFFIX), HEADER + "B,classic_bike,2024-02-01 08:00:00,2024-02-01 08:10:00,S,1,E,2,41.8,-87.6,41.9,-87.7,casual\n")
    q = ingest_trip_files(spark, src, out, ckpt)
    q.awaitTermination(120)
    df = spark.read.parquet(out)
    assert sorted((r.ride_id, str(r.source_month)) for r in df.collect()) == [("A", "202401"), ("B", "202402")]


def test_ingest_with_stateless_clean(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    out = os.path.join(tmpdir_path, "out")
    os.makedirs(src)
    _write(
        os.path.join(src, "202403" + SUFFIX),
        HEADER
        + "A,electric_bike,2024-03-01 08:00:00,2024-03-01 08:10:00,S,1,E,2,41.8,-87.6,41.9,-87.7,member\n"
        + "B,electric_bike,2024-03-01 08:00:00,2024-03-01 08:00:30,S,1,E,2,41.8,-87.6,41.9,-87.7,member\n"
        + "C,NA,2024-03-01 08:00:00,2024-03-01 08:10:00,S,1,E,2,41.8,-87.6,41.9,-87.7,member\n",
    )
    q = ingest_trip_files(spark, src, out, os.path.join(tmpdir_path, "ckpt"), clean=True)
    q.awaitTermination(120)
    # B is under two minutes and C has no bike type: the main clean drops both.
    assert [r.ride_id for r in spark.read.parquet(out).collect()] == ["A"]


def test_two_outputs_of_one_source_both_get_every_row(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    _write(os.path.join(src, "202401" + SUFFIX), HEADER + "A,electric_bike,2024-01-01 08:00:00,2024-01-01 08:10:00,S,1,E,2,41.8,-87.6,41.9,-87.7,member\n")
    for name in ("one", "two"):
        out = os.path.join(tmpdir_path, name)
        ingest_trip_files(spark, src, out, out + "-checkpoint").awaitTermination(120)
        assert [r.ride_id for r in spark.read.parquet(out).collect()] == ["A"]
    with pytest.raises(TypeError):  # no shared default folder
        ingest_trip_files(spark, src, os.path.join(tmpdir_path, "three"))
