"""The frames behind the reference's 13 charts (C6), built from one
materialised ``rides`` table and one materialised ``time_rollup``.

Every chart frame is an aggregate of those two tables; the rides are written
once and the rollup (at most a few thousand rows) once, so no chart re-runs
the cleaning steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.functions.scalar import bike_label, member_label
from ridelens.operators.distribution import boxplot_stats, histogram
from ridelens.operators.geo import area_totals
from ridelens.operators.rollup import USAGE_FRAMES, avg_duration, station_trips, time_rollup, usage_frames
from ridelens.operators.share import share_segments, share_within
from ridelens.plans.composite import legacy_report, legacy_rides, analysis_rides
from ridelens.sources.files import checkpoint_table, write_report
from ridelens.schema import HISTOGRAM_WIDTH

CHARTS = [
    "histogram",
    "histogram_facet",
    "frequency",
    "boxplot",
    "share_segments",
    "monthly_share",
    "monthly_usage",
    "weekday_usage",
    "hour_usage",
    "heatmap",
    "station_map",
    "area_map",
    "avg_duration",
]


def report_frames(rides: DataFrame, rollup: DataFrame, legacy_data: DataFrame, areas: DataFrame) -> dict[str, DataFrame]:
    """The 13 chart frames from the analysis tables."""
    labelled = lambda df: df.withColumn("member_label", member_label("member")).withColumn(
        "bike_label", bike_label("rideable_type")
    )
    stations = station_trips(rides, by_member=True, drop_blank=False, min_trips=0)
    # five frames from one aggregate
    usage = checkpoint_table(usage_frames(rollup), "usage_frames")
    frame = {name: usage.where(F.col("frame") == name).select(*keys, "n") for name, keys in USAGE_FRAMES.items()}
    return {
        "histogram": labelled(histogram(rides, "duration", HISTOGRAM_WIDTH, by=["member", "rideable_type"])),
        "histogram_facet": labelled(histogram(rides, "duration", HISTOGRAM_WIDTH, by=["rideable_type", "member"])),
        "frequency": labelled(frame["frequency"].withColumnRenamed("n", "n_trips")),
        "boxplot": labelled(boxplot_stats(rides, "duration", ["member", "rideable_type"])),
        "share_segments": share_segments(legacy_data),
        "monthly_share": share_within(frame["monthly"], "n", ["date", "member"]),
        "monthly_usage": frame["monthly"],
        "weekday_usage": frame["weekday"],
        "hour_usage": frame["hour"],
        "heatmap": share_within(frame["heatmap"], "n", ["date", "weekday", "hour"]),
        "station_map": stations,
        "area_map": area_totals(stations, areas),
        "avg_duration": avg_duration(rollup, mode="row"),
    }


def build_report(
    trips_raw: DataFrame,
    stations_raw: DataFrame | None,
    areas: DataFrame,
    out_dir: str | None = None,
) -> dict[str, DataFrame]:
    """C2 + C3 + C5 + C6 + C7: materialise the shared tables once, build every
    chart frame, and write them to ``out_dir`` when given (S13)."""
    rides = analysis_rides(trips_raw, stations_raw)  # a filter over the table it has written
    rollup = checkpoint_table(time_rollup(rides), "time_rollup")
    legacy_data = legacy_report(legacy_rides(trips_raw))["data"]
    frames = report_frames(rides, rollup, legacy_data, areas)
    if out_dir is not None:
        write_report(frames, out_dir)
    return frames


def chart_row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per chart frame, as one small frame (no collect)."""
    parts = [f.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("chart"), "rows") for name, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
