"""Rollups (A4-A15, A24, O1-O4).

Every rollup is a ``groupBy().agg()`` with partial aggregation before the
shuffle, so a hot key (a station or segment holding a third of the trips) is
reduced to one row per map task before it moves. The usage frames are built
from ``time_rollup`` (at most 13 x 7 x 24 x 6 rows), not from the trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.schema import MONTH_LEVELS, WEEKDAY_LEVELS
from ridelens.functions.scalar import (
    bike_label,
    exact_ratio,
    member_label,
    month_label,
    month_order,
    safe_ratio,
    segment_label,
    weekday_order,
)
from ridelens.operators.ordered import ordered as ordered_rows

TIME_KEYS = ["year", "month", "weekday", "hour"]


def time_rollup(rides: DataFrame, ordered: bool = False, scale: int | None = None) -> DataFrame:
    """Trips, total and average minutes by calendar keys and segment.

    ``avg_duration`` is SUM/COUNT as a double; ``scale=4`` rounds it as the
    reference's exact decimal division does (T13). ``ordered=True`` sorts the
    result (O1); use it only at a sink.
    """
    out = (
        rides.withColumn("type", segment_label("member", "rideable_type"))
        .groupBy("year", "month", "weekday", "hour", "type", "member", "rideable_type")
        .agg(F.count(F.lit(1)).alias("n_trips"), F.sum(F.col("duration").cast("long")).alias("duration"))
        .withColumn(
            "avg_duration",
            F.col("duration") / F.col("n_trips")
            if scale is None
            else exact_ratio("duration", "n_trips", scale),
        )
        .select("type", *TIME_KEYS, "member", "rideable_type", "n_trips", "duration", "avg_duration")
    )
    if ordered:
        out = out.orderBy(*TIME_KEYS, "type")
    return out


def _level_index(c, levels: Sequence[str]):
    expr = None
    for i, lv in enumerate(levels, start=1):
        expr = (F.when if expr is None else expr.when)(c == lv, F.lit(i))
    return expr


def time_rollup_legacy(legacy: DataFrame, ordered: bool = False) -> DataFrame:
    """Trips and total seconds by year, month label, weekday label, hour, bike
    and member (A6, P16, O4). Labels outside the factor levels get a NULL sort
    key, as an R factor makes them NA."""
    out = (
        legacy.groupBy("year", "month", "day_of_week", "hour_of_day", "rideable_type", "member_casual")
        .agg(
            F.count(F.lit(1)).alias("n_trips"),
            F.sum(F.col("trip_duration").cast("long")).alias("trip_duration"),
        )
        .withColumn("month_level", _level_index(F.col("month"), MONTH_LEVELS))
        .withColumn("weekday_level", _level_index(F.col("day_of_week"), WEEKDAY_LEVELS))
    )
    if ordered:
        out = out.orderBy(
            "year",
            F.asc_nulls_last("month_level"),
            F.asc_nulls_last("weekday_level"),
            "hour_of_day",
            "rideable_type",
            "member_casual",
        )
    return out


def od_rollup(rides: DataFrame, member_col: str = "member") -> DataFrame:
    """Trips and averages by member, start and end station (A5). Grouped by
    ``member`` (D6)."""
    return rides.groupBy(member_col, "start_station_name", "end_station_name").agg(
        F.count(F.lit(1)).alias("n_trips"),
        F.avg("duration").alias("duration"),
        F.avg(F.col("start_lat").cast("double")).alias("s_lat"),
        F.avg(F.col("start_lng").cast("double")).alias("s_lng"),
        F.avg(F.col("end_lat").cast("double")).alias("e_lat"),
        F.avg(F.col("end_lng").cast("double")).alias("e_lng"),
    )


def station_trips(
    rides: DataFrame,
    by_member: bool = False,
    drop_blank: bool = True,
    min_trips: int | None = None,
    name: str = "start_station_name",
    lng: str = "start_lng",
    lat: str = "start_lat",
    member_col: str = "member",
    na_rm: bool = True,
) -> DataFrame:
    """Trips and mean position by start station.

    ``drop_blank`` removes the '' name (and NULL, as a != filter does);
    ``min_trips`` keeps stations with more trips than that; ``n_trips_k`` is
    trips in thousands. ``na_rm=False`` makes a mean NULL when the group has
    a NULL coordinate, as R's ``mean`` does by default.
    """
    keys = [name] + ([member_col] if by_member else [])

    def mean(c):
        m = F.avg(F.col(c).cast("double"))
        return m if na_rm else F.when(F.count(c) == F.count(F.lit(1)), m)

    out = rides.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_trips"),
        mean(lng).alias("lng"),
        mean(lat).alias("lat"),
    )
    if drop_blank:
        out = out.filter(F.col(name) != "")
    if min_trips is not None:
        out = out.filter(F.col("n_trips") > min_trips)
    return out.withColumn("n_trips_k", F.col("n_trips") / F.lit(1000.0))


def top_stations(stations: DataFrame, n: int | None = None, name: str = "start_station_name") -> DataFrame:
    """Stations by trips, descending, name as tie-break, with their ``rank``;
    all of them, or the first ``n`` (O3). Ranked by ranges, not in one task."""
    out = ordered_rows(stations, [F.desc("n_trips"), F.asc(name)], position="rank")
    out = out.withColumn("rank", F.col("rank").cast("int")).orderBy("rank")
    return out.where(F.col("rank") <= n) if n is not None else out


def frequency(rides: DataFrame, keys: Sequence[str] = ("member", "rideable_type")) -> DataFrame:
    """Trips by member and bike, with labels."""
    out = rides.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_trips"))
    if list(keys) == ["member", "rideable_type"]:
        out = out.withColumn("member_label", member_label("member")).withColumn(
            "bike_label", bike_label("rideable_type")
        )
    return out


def with_month_label(rollup: DataFrame) -> DataFrame:
    """Adds ``date`` ('Jan.2024'; NULL outside the levels) and its sort key."""
    return rollup.withColumn("date", month_label("year", "month")).withColumn(
        "date_order", F.when(F.col("date").isNotNull(), month_order("year", "month"))
    )


def usage_by(
    rollup: DataFrame,
    keys: Sequence[str],
    by: Sequence[str] = ("member", "rideable_type"),
    out: str = "n",
) -> DataFrame:
    """Sum of ``n_trips`` of a time rollup by ``keys`` and ``by``.

    ``date`` in ``keys`` means the month label of P15.
    """
    keys = list(keys)
    src = rollup
    group = []
    for k in keys:
        if k == "date":
            src = with_month_label(src) if "date" not in src.columns else src
            group += ["date", "date_order"]
        else:
            group.append(k)
    group += [b for b in by if b not in group]
    return src.groupBy(*group).agg(F.sum("n_trips").alias(out))


#: The usage frames by name: the columns that each is grouped by.
USAGE_FRAMES = {
    "frequency": ["member", "rideable_type"],
    "monthly": ["date", "date_order", "member", "rideable_type"],
    "weekday": ["weekday", "member", "rideable_type"],
    "hour": ["hour", "member", "rideable_type"],
    "heatmap": ["date", "date_order", "weekday", "hour", "member"],
}


def usage_frames(rollup: DataFrame, frames: dict[str, list[str]] = USAGE_FRAMES, out: str = "n") -> DataFrame:
    """Several usage frames (A9-A13) from one aggregate over one scan, by
    grouping sets: ``frame`` names the frame of a row, whose columns are those
    of all frames, NULL where the frame is not grouped by them. ``grouping_id``
    tells such a NULL from one of the data."""
    columns = list(dict.fromkeys(c for keys in frames.values() for c in keys))
    src = with_month_label(rollup) if "date" in columns and "date" not in rollup.columns else rollup
    sets = [[F.col(c) for c in keys] for keys in frames.values()]
    summed = src.groupingSets(sets, *columns).agg(F.grouping_id().alias("__id"), F.sum("n_trips").alias(out))
    name = F.lit(None).cast("string")
    for frame, keys in frames.items():
        left_out = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)
        name = F.when(F.col("__id") == left_out, F.lit(frame)).otherwise(name)
    return summed.select(name.alias("frame"), *columns, out)


def avg_duration(rollup: DataFrame, mode: str = "weighted") -> DataFrame:
    """Average minutes by segment and weekday.

    ``mode="row"`` is the reference as written: one ratio per rollup row (P20).
    ``mode="weighted"`` is one value per group: total minutes / total trips.
    """
    if mode == "row":
        return rollup.select(
            "type", "weekday", safe_ratio("duration", "n_trips").alias("avg_duration")
        )
    if mode == "weighted":
        return rollup.groupBy("type", "weekday").agg(
            safe_ratio(F.sum("duration"), F.sum("n_trips")).alias("avg_duration"),
            F.sum("n_trips").alias("n_trips"),
        )
    raise ValueError(f"mode must be 'row' or 'weighted', not {mode!r}")


def weekday_sort_key(df: DataFrame, col: str = "weekday") -> DataFrame:
    """Monday-first sort key for a 1 = Sunday weekday number."""
    return df.withColumn(f"{col}_order", weekday_order(col))
