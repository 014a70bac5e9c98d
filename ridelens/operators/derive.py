"""Typing, narrowing and ride derivation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelens.functions.scalar import (
    bike_code,
    haversine_m,
    member_flag,
    minutes_between,
    month_abbr,
    seconds_between,
    weekday_abbr,
)
from ridelens.schema import LEGACY_MAX_TEXT_LENGTH, MAX_TEXT_LENGTH, RIDES_TYPES

_INT_RANGES = {
    "tinyint": (-128, 127),
    "smallint": (-32768, 32767),
    "int": (-(2**31), 2**31 - 1),
}


def _round_to_second(c: Column) -> Column:
    """DATETIME without fractional digits rounds to the nearest second.

    Rebuilt from its own fields, so no time zone is involved: the seconds
    (an exact decimal) are rounded half up, and a rounded 60 rolls over into
    the next minute.
    """
    secs = F.round(F.extract(F.lit("SECOND"), c), 0)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), secs)


def type_timestamps(df: DataFrame, cols=("started_at", "ended_at"), to_second: bool = True, strict: bool = False) -> DataFrame:
    """Zone-less timestamps (P2) of whole seconds, as the reference's column
    type has them (T9); ``to_second=False`` keeps fractions. Text that is not a timestamp becomes NULL,
    or raises with ``strict=True`` (T16)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in cols:
            if f.dataType.typeName() != "timestamp_ntz":
                c = c.cast("timestamp_ntz") if strict else c.try_cast("timestamp_ntz")
            if to_second:
                c = _round_to_second(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def checked_cast(c: Column, type_name: str, name: str, max_len: int | None = MAX_TEXT_LENGTH) -> Column:
    """Cast that fails on overflow or over-long text whatever the session's
    ANSI setting (P4). ``VARCHAR(n)`` is checked explicitly because a cast to
    it keeps the whole string."""
    if type_name in _INT_RANGES:
        lo, hi = _INT_RANGES[type_name]
        ok = c.isNull() | c.between(lo, hi)
        return F.when(ok, c.cast(type_name)).otherwise(F.raise_error(F.lit(f"value of {name} out of range for {type_name}")).cast(type_name))
    if type_name == "string" and max_len is not None:
        ok = c.isNull() | (F.length(c) <= max_len)
        return F.when(ok, c.cast("string")).otherwise(F.raise_error(F.lit(f"{name} longer than {max_len}")).cast("string"))
    return c.cast(type_name)


def narrow(df: DataFrame, types: Mapping[str, str] = RIDES_TYPES, max_len: int | None = MAX_TEXT_LENGTH) -> DataFrame:
    """Narrow the columns to ``types`` with checked casts."""
    cols = []
    for f in df.schema.fields:
        if f.name in types:
            cols.append(checked_cast(F.col(f.name), types[f.name], f.name, max_len).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


LEGACY_TYPES = {
    "ride_id": "string",
    "rideable_type": "string",
    "started_at": "timestamp_ntz",
    "ended_at": "timestamp_ntz",
    "start_station_name": "string",
    "start_station_id": "string",
    "end_station_name": "string",
    "end_station_id": "string",
    "start_lat": "float",
    "start_lng": "float",
    "end_lat": "float",
    "end_lng": "float",
}


def type_trips(df: DataFrame, max_len: int = LEGACY_MAX_TEXT_LENGTH, to_second: bool = True) -> DataFrame:
    """Legacy full typing of the trip columns (P3, P5): drops the loader's
    ``row_names``, texts checked to 128 characters, coordinates to FLOAT,
    timestamps to whole seconds (``to_second=False`` keeps fractions)."""
    if "row_names" in df.columns:
        df = df.drop("row_names")
    typed = narrow(df, LEGACY_TYPES, max_len=max_len)
    if not to_second:
        return typed
    times = [c for c, kind in LEGACY_TYPES.items() if kind == "timestamp_ntz" and c in typed.columns]
    return typed.withColumns({c: _round_to_second(F.col(c)) for c in times})


def derive_rides(trips: DataFrame, strict_coordinates: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """The analysis table (P7): member flag, bike code, whole minutes, metres,
    calendar fields and eight passthrough columns; one projection. ``also``
    passes further columns on."""
    return trips.select(
        member_flag("member_casual").alias("member"),
        bike_code("rideable_type").alias("rideable_type"),
        minutes_between("started_at", "ended_at").alias("duration"),
        # ROUND of a DOUBLE follows the C library on the reference's server:
        # half to even.
        F.bround(
            haversine_m("start_lng", "start_lat", "end_lng", "end_lat", strict=strict_coordinates), 0
        ).alias("distance"),
        F.hour("started_at").alias("hour"),
        F.dayofweek("started_at").alias("weekday"),
        F.month("started_at").alias("month"),
        F.year("started_at").alias("year"),
        "start_station_name",
        "start_station_id",
        "end_station_name",
        "end_station_id",
        "start_lat",
        "start_lng",
        "end_lat",
        "end_lng",
        *also,
    )


def derive_rides_legacy(trips: DataFrame, keep_ids: bool = True) -> DataFrame:
    """The legacy analysis table (P8): raw member and bike strings, seconds,
    hour, weekday and month labels, year. Station ids are kept (D14)."""
    ids = ["start_station_id", "end_station_id"] if keep_ids else []
    return trips.select(
        "member_casual",
        "rideable_type",
        seconds_between("started_at", "ended_at").cast("int").alias("trip_duration"),
        F.hour("started_at").alias("hour_of_day"),
        weekday_abbr("started_at").alias("day_of_week"),
        month_abbr("started_at").alias("month"),
        F.year("started_at").alias("year"),
        "start_station_name",
        *ids[:1],
        "end_station_name",
        *ids[1:],
        "start_lat",
        "start_lng",
        "end_lat",
        "end_lng",
    )
