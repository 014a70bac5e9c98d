"""Trip-shaped views over the driver's tables (FIXTURES.md section 3).

``events`` becomes a month-spread trip log with the defects the cleaning
operators exist for (NULLs, blanks, duplicated keys, suffixed station names,
conflicting ids); ``nation`` becomes a published station list and ``region``
a set of areas, holed, concave and in parts. Every row of ``events`` is used, so the work of
every query grows with the table.
"""

from __future__ import annotations

import os
import posixpath
import threading
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelens.schema import TRIPS_RAW
from ridelens.session import is_scratch, scratch_path
from ridelens.sources.files import read_trip_text, write_table


# Columns of the driver tables that the views read; a declared schema skips
# footer inference (the files may hold more columns).
_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in _SCHEMAS:
        reader = reader.schema(_SCHEMAS[name])
    return reader.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def _txt(c):
    return c.cast("string")


def trips_from_events(events: DataFrame) -> DataFrame:
    """The raw trip table, ``TRIPS_RAW`` plus ``source_month``.

    Rows with ``event_id % 101 = 0`` appear twice (duplicated ride ids). The
    copy is made with a generator in the same scan, not a second scan.
    """
    e = F.col("event_id")
    k = F.col("user_id") % 20
    m = (F.col("user_id") + e) % 20
    copies = F.explode(F.sequence(F.lit(1), F.when(e % 101 == 0, F.lit(2)).otherwise(F.lit(1))))
    ev = events.select("event_id", "ts", "user_id", "event_type", "value", copies.alias("__copy"))
    # months run on past the reference's range for some; starts and ends have
    # different fractions of a second
    later = F.when(e % 97 == 0, F.lit(150)).otherwise(F.lit(0))
    started = F.col("ts") + F.make_dt_interval(days=((e % 13) * 30 + later).cast("int"))
    span = (
        F.when(e % 211 == 0, F.lit(-300))  # ends before it starts
        .when(e % 223 == 0, F.lit(26 * 3600))  # over a day
        .otherwise(F.round(F.col("value") * 60).cast("int"))
    )
    fraction = (e % 3).cast("decimal(3,0)") * F.lit(Decimal("0.4"))
    ended = started + F.make_dt_interval(secs=(span.cast("decimal(9,0)") + fraction).cast("decimal(18,6)"))

    def some(c, divisor: int):
        """``c``, NULL for one event in ``divisor``."""
        return F.when(e % divisor != 0, c)

    station_k = F.concat(F.lit("Station "), _txt(k))
    station_m = F.concat(F.lit("Station "), _txt(m))
    return ev.select(
        some(F.concat(F.lit("R"), _txt(e)), 499).alias("ride_id"),
        F.when(e % 61 == 0, F.lit(None).cast("string"))
        .when(F.col("event_type") == "click", F.lit("electric_bike"))
        .when(F.col("event_type") == "view", F.lit("classic_bike"))
        .otherwise(F.lit("electric_scooter"))
        .alias("rideable_type"),
        some(started, 541).alias("started_at"),
        F.when(e % 67 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(ended).alias("ended_at"),
        F.when(e % 7 == 0, F.lit(""))
        .when(e % 667 == 0, F.concat(F.lit("Public Rack - "), station_k, F.lit(" (TEMPORARY)")))
        .when(e % 23 == 0, F.concat(F.lit("Public Rack - "), station_k))
        .when(e % 29 == 0, F.concat(station_k, F.lit(" (TEMPORARY)")))
        .otherwise(station_k)
        .alias("start_station_name"),
        F.when(e % 31 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("ID"), _txt(k), F.when(e % 19 == 0, F.lit("B")).otherwise(F.lit(""))))
        .alias("start_station_id"),
        F.when(e % 14 == 0, F.lit(""))
        .when(e % 71 == 0, F.lit(None).cast("string"))
        .when(e % (37 * 11) == 0, F.concat(F.lit("Public Rack - "), station_m, F.lit(" (TEMPORARY)")))
        .when(e % 37 == 0, F.concat(F.lit("Public Rack - "), station_m))
        .when(e % 43 == 0, F.concat(station_m, F.lit(" (TEMPORARY)")))
        .otherwise(station_m)
        .alias("end_station_name"),
        F.concat(F.lit("ID"), _txt(m), F.when(e % 17 == 0, F.lit("B")).otherwise(F.lit(""))).alias("end_station_id"),
        some(F.lit(41.65) + F.lit(0.02) * k + F.lit(0.0001) * (e % 5), 503).alias("start_lat"),
        some(F.lit(-87.90) + F.lit(0.015) * k, 509).alias("start_lng"),
        F.when(e % 73 == 0, F.lit(None).cast("double")).otherwise(F.lit(41.65) + F.lit(0.02) * m).alias("end_lat"),
        some(F.lit(-87.90) + F.lit(0.015) * m, 521).alias("end_lng"),
        some(F.when(F.col("user_id") % 2 == 0, F.lit("member")).otherwise(F.lit("casual")), 523).alias("member_casual"),
        F.concat(F.lpad(F.year(started).cast("string"), 4, "0"), F.lpad(F.month(started).cast("string"), 2, "0")).alias(
            "source_month"
        ),
    )


def stations_raw_from_nation(nation: DataFrame) -> DataFrame:
    """A published station list: all 25 nations, names 'Station (n % 20)' so
    that five names appear twice (T14), no short name when ``n % 6 = 0``."""
    n = F.col("n_nationkey")
    return nation.select(
        _txt(n).alias("ID"),
        F.concat(F.lit("Station "), _txt(n % 20)).alias("Station Name"),
        F.when(n % 6 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("STN"), _txt(n))).alias("Short Name"),
        (F.lit(10) + n).cast("int").alias("Total Docks"),
        (F.lit(10) + n - n % 3).cast("int").alias("Docks in Service"),
        F.lit("In Service").alias("Status"),
        (F.lit(41.651) + F.lit(0.02) * n).alias("Latitude"),
        (F.lit(-87.901) + F.lit(0.015) * n).alias("Longitude"),
    )


def areas_from_region(region: DataFrame) -> DataFrame:
    """One area per region between lng -88 and -87 and lat y0 and y1, with
    ``y0 = 41.64 + 0.08 r`` and ``y1 = y0 + 0.08``, of a shape of its own:
    r = 0 has a triangular hole, r = 1 a notch cut from the west (concave), r = 2
    is two parts, a rectangle and a triangle, and others are rectangles. Region 4
    is moved 5 degrees north so that it holds no station (the zero-fill case)."""
    r = F.col("r_regionkey")
    y0 = F.lit(41.64) + F.lit(0.08) * r + F.when(r == 4, F.lit(5.0)).otherwise(F.lit(0.0))
    y1 = y0 + F.lit(0.08)
    at = lambda k: y0 + F.lit(k)
    pt = lambda x, y: F.array(F.lit(x), y)
    ring = F.array(pt(-88.0, y0), pt(-87.0, y0), pt(-87.0, y1), pt(-88.0, y1), pt(-88.0, y0))
    hole = F.array(pt(-87.91, at(0.02)), pt(-87.86, at(0.02)), pt(-87.885, at(0.06)), pt(-87.91, at(0.02)))
    notched = F.array(
        pt(-88.0, y0), pt(-87.0, y0), pt(-87.0, y1), pt(-88.0, y1), pt(-88.0, at(0.06)), pt(-87.79, at(0.05)), pt(-88.0, at(0.04)), pt(-88.0, y0)
    )
    low = F.array(pt(-88.0, y0), pt(-87.0, y0), pt(-87.0, at(0.04)), pt(-88.0, at(0.04)), pt(-88.0, y0))
    high = F.array(pt(-87.75, at(0.06)), pt(-87.72, at(0.06)), pt(-87.735, y1), pt(-87.75, at(0.06)))
    shape = (
        F.when(r == 0, F.array(F.array(ring, hole)))
        .when(r == 1, F.array(F.array(notched)))
        .when(r == 2, F.array(F.array(low), F.array(high)))
        .otherwise(F.array(F.array(ring)))
    )
    return region.select(r.cast("long").alias("area_id"), F.col("r_name").alias("community"), shape.alias("polygon"))


TRIPS_TABLE_SCHEMA = T.StructType(TRIPS_RAW.fields + [T.StructField("source_month", T.StringType())])

# (application, folder, events file state, table) -> path of the written table
_LOADED: dict[tuple, str] = {}
_LOCK = threading.RLock()


def _shared(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The path of a table that is written once per session and input, the
    first time that it is asked for. It goes with the session's other
    intermediate tables (``session.clear_scratch``)."""
    try:
        st = os.stat(posixpath.join(sf_dir, "events.parquet"))
        stamp = (st.st_size, st.st_mtime_ns)
    except OSError:
        stamp = None
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), stamp, name)
    with _LOCK:
        path = _LOADED.get(key)
        if path is None or not is_scratch(path):
            path = scratch_path(spark, "tables", name)
            write(path)
            _LOADED[key] = path
    return path


def load_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip view written once per session as a parquet table partitioned
    by ``source_month`` (the reference's load step, S5), then read with an
    explicit schema. Queries on it get column pruning, pushed filters and
    month partition pruning, as they would on a real trip table."""
    write = lambda path: write_table(trips_from_events(table(spark, sf_dir, "events")), path, partition_by=["source_month"])
    return spark.read.schema(TRIPS_TABLE_SCHEMA).parquet(_shared(spark, sf_dir, "trips_raw", write))


def shared_copy(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table derived from the fixture views, written once per session and
    input and shared by every query on it."""
    frame = build()
    return spark.read.schema(frame.schema).parquet(_shared(spark, sf_dir, name, frame.write.parquet))


def trip_lines(events: DataFrame) -> DataFrame:
    """The trip view as lines of comma-separated text, with ``source_month``.
    Of rides with a number e, one in 89 has no time for a start, one in 83 no
    number for a start latitude, one in 79 none for an end longitude, and one in
    73 lacks its last fields."""
    trips = trips_from_events(events)
    e = F.substring("ride_id", 2, 20).cast("long")
    text = {f.name: F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in TRIPS_RAW.fields}
    for name, divisor, wrong in (("started_at", 89, "not a time"), ("start_lat", 83, "north"), ("end_lng", 79, "--")):
        text[name] = F.when(e % divisor == 0, F.lit(wrong)).otherwise(text[name])
    whole = F.concat_ws(",", *text.values())
    return trips.select(F.when(e % 73 == 0, F.substring_index(whole, ",", 5)).otherwise(whole).alias("line"), "source_month")


def load_trip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines written once per session, a folder per month, and read as
    trip text with ``source_month`` and the malformed lines."""
    write = lambda path: trip_lines(table(spark, sf_dir, "events")).write.partitionBy("source_month").text(path)
    return read_trip_text(spark, _shared(spark, sf_dir, "trip_lines", write))


def load(spark: SparkSession, sf_dir: str, materialize: bool = True) -> dict[str, DataFrame]:
    """The three views for a scale-factor folder."""
    trips = load_trips(spark, sf_dir) if materialize else trips_from_events(table(spark, sf_dir, "events"))
    return {
        "trips_raw": trips,
        "stations_raw": stations_raw_from_nation(table(spark, sf_dir, "nation")),
        "areas": areas_from_region(table(spark, sf_dir, "region")),
    }
