"""Schemas, value domains and parameters of the trip data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw trip file, one per month; ``source_month`` is added from the file name.
TRIPS_RAW = T.StructType(
    [
        T.StructField("ride_id", T.StringType()),
        T.StructField("rideable_type", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("ended_at", T.TimestampNTZType()),
        T.StructField("start_station_name", T.StringType()),
        T.StructField("start_station_id", T.StringType()),
        T.StructField("end_station_name", T.StringType()),
        T.StructField("end_station_id", T.StringType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("start_lng", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField("end_lng", T.DoubleType()),
        T.StructField("member_casual", T.StringType()),
    ]
)

TEXT_COLUMNS = [f.name for f in TRIPS_RAW.fields if isinstance(f.dataType, T.StringType)]

# Station list as published (headers with spaces).
STATIONS_RAW = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("Station Name", T.StringType()),
        T.StructField("Short Name", T.StringType()),
        T.StructField("Total Docks", T.IntegerType()),
        T.StructField("Docks in Service", T.IntegerType()),
        T.StructField("Status", T.StringType()),
        T.StructField("Latitude", T.DoubleType()),
        T.StructField("Longitude", T.DoubleType()),
    ]
)

STATIONS = T.StructType(
    [
        T.StructField("s_name", T.StringType()),
        T.StructField("s_id", T.StringType()),
        T.StructField("lat", T.FloatType()),
        T.StructField("lng", T.FloatType()),
    ]
)

# Narrowed analysis table (``rides``): column -> Spark type name.
RIDES_TYPES = {
    "member": "boolean",
    "rideable_type": "tinyint",
    "duration": "int",
    "distance": "int",
    "hour": "tinyint",
    "weekday": "tinyint",
    "month": "tinyint",
    "year": "smallint",
    "start_station_name": "string",
    "start_station_id": "string",
    "end_station_name": "string",
    "end_station_id": "string",
    "start_lat": "float",
    "start_lng": "float",
    "end_lat": "float",
    "end_lng": "float",
}
RIDES_COLUMNS = list(RIDES_TYPES)

# Columns a trip needs to be kept by the main clean (F1).
REQUIRED_COLUMNS = [
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "member_casual",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
]
# The legacy clean checks seven columns, without the two longitudes.
LEGACY_REQUIRED_COLUMNS = [
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "member_casual",
    "start_lat",
    "end_lat",
]
# Columns of the null audit (A1).
AUDIT_COLUMNS = [
    "member_casual",
    "rideable_type",
    "start_station_name",
    "start_station_id",
    "start_lat",
    "start_lng",
    "end_station_name",
    "end_station_id",
    "end_lat",
    "end_lng",
]

# ---------------------------------------------------------------------------
# These must equal the reference's for equal results.
#
# File name pattern of the monthly trip files (unanchored regular expression)
# and the suffix removed from a file name to name its month.
TRIP_FILE_REGEX = "202[4-5]{1}[0-1]{1}[0-9]{1}-divvy-tripdata.csv"
TRIP_FILE_SUFFIX = "-divvy-tripdata.csv"
# Member and bike values as written in the trip files.
MEMBER_VALUE = "member"
CASUAL_VALUE = "casual"
RAW_BIKE_TYPES = ("electric_bike", "classic_bike", "electric_scooter")
# Bike codes: electric_bike 1, classic_bike 2, anything else 3.
BIKE_CODES = {"electric_bike": 1, "classic_bike": 2}
BIKE_OTHER_CODE = 3
BIKE_LABELS = {1: "Electric Bike", 2: "Classic Bike", 3: "Electric Scooter"}
MEMBER_LABELS = {True: "Member", False: "Casual"}
SEGMENT_PREFIXES = {True: "M-", False: "C-"}
# Label levels of the monthly charts: Jan.2024 .. Jan.2025.
FIRST_MONTH = (2024, 1)
LAST_MONTH = (2025, 1)
# Month and weekday labels: the legacy table's labels by number (day 1 is
# Sunday), and the weekday factor levels of the legacy report (Monday first).
MONTH_LEVELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
WEEKDAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
WEEKDAY_LEVELS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
# Radius of the sphere of the distance function, metres.
EARTH_RADIUS_M = 6370986.0
# Name patterns left out of the name-conflict audits.
PUBLIC_RACK_PATTERN = "Public Rack - %"
PUBLIC_RACK_PREFIX = "Public Rack%"
TEMPORARY_SUFFIX = "%TEMPORARY)"
# Text widths of the narrowed tables.
MAX_TEXT_LENGTH = 64
LEGACY_MAX_TEXT_LENGTH = 128
# Span rules of the legacy script (disabled there): seconds.
MIN_TRIP_SECONDS = 60
MAX_TRIP_SECONDS = 86400
# Chart statistics: histogram bin width; box-plot whisker reach in IQRs and
# notch factor of the plotting library the reference uses.
HISTOGRAM_WIDTH = 2.0
BOX_WHISKER_COEF = 1.5
BOX_NOTCH_FACTOR = 1.58
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CleanParams:
    """Thresholds of the main clean (F4): keep trips of lo..hi whole minutes."""

    min_minutes_exclusive: int = 1  # delete duration <= 1
    max_minutes_inclusive: int = 210  # delete duration > 210
    required: tuple[str, ...] = tuple(REQUIRED_COLUMNS)


@dataclass(frozen=True)
class ZScoreParams:
    k: float = 3.0
    sd: str = "pop"  # "pop" (SQL STDDEV) or "samp" (R scale)
    strict: bool = False  # False: delete abs(z) > k; True: keep abs(z) < k
