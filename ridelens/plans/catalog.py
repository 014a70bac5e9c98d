"""Registered queries: one per operator family of SURVEY 7.4.

Each takes ``(spark, sf_dir)``, builds the fixture views over the whole
driver tables and returns a DataFrame. Doubles that are sums or averages of
doubles are rounded to 6 places so that a different summation order cannot
change the value compared by the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelens.functions.scalar import bike_label, haversine_m, member_label, minutes_between, to_minutes
from ridelens.operators.clean import clean_trips, drop_all_duplicates, duplicate_keys, keep_in, null_audit
from ridelens.operators.conform import canonical_id, canonical_name, conflict_audit, distinct_count
from ridelens.operators.derive import derive_rides, derive_rides_legacy, narrow, type_timestamps, type_trips
from ridelens.operators.distribution import boxplot_outliers, boxplot_stats, histogram
from ridelens.operators.geo import area_totals, within_join
from ridelens.operators.identity import station_identity, unify_stations
from ridelens.operators.monthly import (
    HLL_BOUND,
    KLL_BOUND,
    merged_sketches,
    merged_time_rollup,
    month_sketches,
    replace_months,
    time_state,
)
from ridelens.operators.ordered import ordered, write_ordered
from ridelens.operators.outliers import drop_zscore, zscore
from ridelens.operators.predicates import (
    delete_where,
    drop_longer_than,
    drop_missing,
    drop_non_positive_span,
    drop_shorter_than,
)
from ridelens.operators.rollup import (
    avg_duration,
    frequency,
    od_rollup,
    station_trips,
    time_rollup,
    top_stations,
    usage_by,
    usage_frames,
)
from ridelens.operators.share import share_segments, share_within
from ridelens.plans import fixtures
from ridelens.plans.composite import (
    area_trips,
    clean_ledger,
    clean_trips_table,
    drop_outliers,
    fix_station_ids,
    legacy_derived,
    legacy_ledger,
    legacy_report,
    rides_narrow,
    statement_ledger,
    trim_legacy,
)
from ridelens.schema import (
    AUDIT_COLUMNS,
    HISTOGRAM_WIDTH,
    LEGACY_REQUIRED_COLUMNS,
    PUBLIC_RACK_PATTERN,
    PUBLIC_RACK_PREFIX,
    TEMPORARY_SUFFIX,
)
from ridelens.session import scratch_path
from ridelens.sources.files import (
    checkpoint_table,
    month_names,
    preview,
    reject_counts,
    split_rejected,
    union_months,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]


def _views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixtures.load(spark, sf_dir)


def _trips(spark, sf_dir):
    return type_timestamps(_views(spark, sf_dir)["trips_raw"])


def _dedup(spark, sf_dir):
    return clean_trips_table(_views(spark, sf_dir)["trips_raw"])


def _rides_unfiltered(spark, sf_dir):
    # The reference derives its rides after the station-conformance update.
    v = _views(spark, sf_dir)
    return fixtures.shared_copy(spark, sf_dir, "rides_narrow", lambda: rides_narrow(v["trips_raw"], v["stations_raw"], materialize=False))


def _rides(spark, sf_dir):
    return drop_outliers(_rides_unfiltered(spark, sf_dir))


def _rides_plain(spark, sf_dir):
    trips = _views(spark, sf_dir)["trips_raw"]
    return drop_outliers(fixtures.shared_copy(spark, sf_dir, "rides_plain", lambda: rides_narrow(trips, materialize=False)))


def _legacy_trimmed(spark, sf_dir):
    trips = _views(spark, sf_dir)["trips_raw"]
    return trim_legacy(fixtures.shared_copy(spark, sf_dir, "legacy_derived", lambda: legacy_derived(trips, materialize=False)))


def _legacy_fixed(spark, sf_dir):
    # The name audits and the name fix come after both id rewrites.
    trimmed = lambda: fix_station_ids(_legacy_trimmed(spark, sf_dir))
    return fixtures.shared_copy(spark, sf_dir, "legacy_fixed", trimmed)


def _legacy_complete(spark, sf_dir):
    typed = type_trips(_views(spark, sf_dir)["trips_raw"].drop("source_month"))
    return drop_missing(drop_all_duplicates(typed, ["ride_id"]), LEGACY_REQUIRED_COLUMNS)


def _round(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# -- scans, cleaning --------------------------------------------------------


def q_union_months(spark, sf_dir):
    trips = _views(spark, sf_dir)["trips_raw"]
    months = month_names("202401", "202501")
    return union_months({m: trips.filter(F.col("source_month") == m).drop("source_month") for m in months})


def q_load_text(spark, sf_dir):
    """The load path: trip text, typed, malformed rows left out."""
    good, _ = split_rejected(fixtures.load_trip_text(spark, sf_dir))
    return type_timestamps(good)


def q_load_rejects(spark, sf_dir):
    return reject_counts(*split_rejected(fixtures.load_trip_text(spark, sf_dir)))


def q_delete_where_3vl(spark, sf_dir):
    t = _trips(spark, sf_dir)
    a, b = F.col("start_station_name"), F.col("end_station_name")
    # The reference's '= NULL' pair is kept verbatim: it is never TRUE.
    pred = ((a == F.lit(None)) & (b == F.lit(None))) | ((a == "") & (b == ""))
    return delete_where(t, pred)


def q_clean_trips(spark, sf_dir):
    return clean_trips(_trips(spark, sf_dir))


def q_drop_all_duplicates(spark, sf_dir):
    return _dedup(spark, sf_dir)


def q_drop_duplicates_keep_one(spark, sf_dir):
    return drop_all_duplicates(clean_trips(_trips(spark, sf_dir)), ["ride_id"], keep="one")


def q_keep_in(spark, sf_dir):
    cleaned = clean_trips(_trips(spark, sf_dir))
    return keep_in(cleaned, duplicate_keys(cleaned, ["ride_id"]), ["ride_id"])


def q_null_audit(spark, sf_dir):
    v = _views(spark, sf_dir)
    return null_audit(clean_trips_table(v["trips_raw"], v["stations_raw"]), AUDIT_COLUMNS)


def q_conform_station(spark, sf_dir):
    v = _views(spark, sf_dir)
    return clean_trips_table(v["trips_raw"], v["stations_raw"])


def q_span_rules(spark, sf_dir):
    t = _legacy_complete(spark, sf_dir)
    return drop_shorter_than(drop_longer_than(drop_non_positive_span(t)))


def q_legacy_missing(spark, sf_dir):
    legacy = derive_rides_legacy(_legacy_complete(spark, sf_dir))
    return legacy.filter(F.col("trip_duration") > 0)


def q_cleaning_ledger(spark, sf_dir):
    return clean_ledger(_views(spark, sf_dir)["trips_raw"])


def q_statement_ledger(spark, sf_dir):
    v = _views(spark, sf_dir)
    return statement_ledger(v["trips_raw"], v["stations_raw"])


def q_legacy_ledger(spark, sf_dir):
    return legacy_ledger(_views(spark, sf_dir)["trips_raw"])


def q_preview(spark, sf_dir):
    return preview(_dedup(spark, sf_dir), 6, order_by="ride_id")


# -- derivation and types ---------------------------------------------------


def q_type_trips(spark, sf_dir):
    return type_trips(_views(spark, sf_dir)["trips_raw"].drop("source_month"))


def q_derive_rides(spark, sf_dir):
    v = _views(spark, sf_dir)
    return derive_rides(clean_trips_table(v["trips_raw"], v["stations_raw"]))


def q_derive_rides_legacy(spark, sf_dir):
    return derive_rides_legacy(_legacy_complete(spark, sf_dir))


def q_narrow_types(spark, sf_dir):
    return _rides_unfiltered(spark, sf_dir)


def q_haversine(spark, sf_dir):
    t = _dedup(spark, sf_dir)
    d = haversine_m("start_lng", "start_lat", "end_lng", "end_lat")
    back = haversine_m("end_lng", "end_lat", "start_lng", "start_lat")
    return t.select("ride_id", F.round(d, 0).alias("distance_m"), F.round(back, 0).alias("distance_back_m"))


def q_to_minutes_half_even(spark, sf_dir):
    legacy = derive_rides_legacy(_legacy_complete(spark, sf_dir))
    return legacy.select("trip_duration", to_minutes("trip_duration", "half_even").alias("minutes"))


def q_to_minutes_half_up(spark, sf_dir):
    legacy = derive_rides_legacy(_legacy_complete(spark, sf_dir))
    return legacy.select("trip_duration", to_minutes("trip_duration", "half_up").alias("minutes"))


# -- outliers ---------------------------------------------------------------


def q_zscore_pop(spark, sf_dir):
    return _rides_plain(spark, sf_dir)


def q_zscore_samp(spark, sf_dir):
    return drop_zscore(_rides_unfiltered(spark, sf_dir), "duration", k=3.0, sd="samp", strict=True)


def q_analysis_rides(spark, sf_dir):
    return _rides(spark, sf_dir)


def q_zscore_columns(spark, sf_dir):
    """Both z-scores of each ride's minutes and what either cut says at 2."""
    rides = _rides_unfiltered(spark, sf_dir).select("member", "rideable_type", "duration")
    both = zscore(zscore(rides, "duration", sd="pop", out="z_pop"), "duration", sd="samp", out="z_samp")
    flags = {"kept_pop": ~F.coalesce(F.abs("z_pop") > 2, F.lit(False)), "kept_samp": F.coalesce(F.abs("z_samp") < 2, F.lit(False))}
    return _round(both.withColumns(flags), ["z_pop", "z_samp"], 9)


# -- rollups ----------------------------------------------------------------


def q_time_rollup(spark, sf_dir):
    return time_rollup(_rides(spark, sf_dir))


def q_time_rollup_decimal(spark, sf_dir):
    return time_rollup(_rides(spark, sf_dir), scale=4)


def _rides_by_month(spark, sf_dir):
    v = _views(spark, sf_dir)
    rides = lambda: narrow(derive_rides(clean_trips_table(v["trips_raw"], v["stations_raw"]), also=("source_month",)))
    return fixtures.shared_copy(spark, sf_dir, "rides_by_month", rides)


def q_time_rollup_merged(spark, sf_dir):
    """States stored by month: all months once, one of them at first without
    half of its rides and then replaced, and the rollup merged from them."""
    rides = _rides_by_month(spark, sf_dir)
    path = scratch_path(spark, "tables", "time_state")
    months = [r.source_month for r in rides.select("source_month").distinct().orderBy("source_month").collect()]
    late = months[len(months) // 2 :][:1]
    write_table(time_state(rides.where(~F.col("source_month").isin(late) | (F.col("hour") < 12))), path, ["source_month"])
    if late:
        replace_months(time_state(rides.where(F.col("source_month").isin(late))), path, late)
    return merged_time_rollup(spark.read.schema(time_state(rides).schema).parquet(path))


def q_month_sketches(spark, sf_dir):
    """By member: distinct start stations and quartiles of the minutes, exact,
    and whether the sketches merged over all months are within their bounds."""
    rides = _rides_by_month(spark, sf_dir)
    sketches = checkpoint_table(month_sketches(rides, ["member"], "start_station_name", "duration"), "month_sketches")
    merged = checkpoint_table(merged_sketches(sketches, ["member"]), "merged_sketches")
    exact = rides.groupBy("member").agg(
        F.count(F.lit(1)).alias("n_trips"), F.count_distinct("start_station_name").alias("n_stations")
    )
    ranks = [
        # the share of rides below, and up to, the sketch's quantile lies around the asked one
        F.avg((F.col("duration") < F.col(f"q{q}")).cast("double")) <= q / 100 + KLL_BOUND for q in (25, 50, 75)
    ] + [F.avg((F.col("duration") <= F.col(f"q{q}")).cast("double")) >= q / 100 - KLL_BOUND for q in (25, 50, 75)]
    within = ranks[0]
    for r in ranks[1:]:
        within = within & r
    placed = rides.join(F.broadcast(merged), "member").groupBy("member").agg(within.alias("quantiles_within"), F.max("n_distinct").alias("estimate"))
    both = exact.join(placed, "member")
    close = F.abs(F.col("estimate") - F.col("n_stations")) <= F.greatest(F.lit(1.0), HLL_BOUND * F.col("n_stations"))
    return both.select("member", "n_trips", "n_stations", close.alias("distinct_within"), "quantiles_within")


def q_od_rollup(spark, sf_dir):
    return _round(od_rollup(_rides(spark, sf_dir)), ["duration", "s_lat", "s_lng", "e_lat", "e_lng"])


def q_frequency(spark, sf_dir):
    return frequency(_rides(spark, sf_dir))


def q_monthly_usage(spark, sf_dir):
    return usage_by(time_rollup(_rides(spark, sf_dir)), ["date"])


def q_weekday_usage(spark, sf_dir):
    return usage_by(time_rollup(_rides(spark, sf_dir)), ["weekday"])


def q_hour_usage(spark, sf_dir):
    return usage_by(time_rollup(_rides(spark, sf_dir)), ["hour"])


def q_usage_frames(spark, sf_dir):
    return usage_frames(time_rollup(_rides(spark, sf_dir)))


def q_heatmap(spark, sf_dir):
    grid = usage_by(time_rollup(_rides(spark, sf_dir)), ["date", "weekday", "hour"], by=["member"])
    return share_within(grid, "n", ["date", "weekday", "hour"])


def q_monthly_share(spark, sf_dir):
    monthly = usage_by(time_rollup(_rides(spark, sf_dir)), ["date"])
    return share_within(monthly, "n", ["date", "member"])


def q_avg_duration_row(spark, sf_dir):
    return avg_duration(time_rollup(_rides(spark, sf_dir)), mode="row")


def q_avg_duration_weighted(spark, sf_dir):
    return avg_duration(time_rollup(_rides(spark, sf_dir)), mode="weighted")


def q_time_rollup_legacy(spark, sf_dir):
    return legacy_report(_legacy_fixed(spark, sf_dir))["data_time"]


def q_share_segments(spark, sf_dir):
    data = legacy_report(_legacy_fixed(spark, sf_dir))["data"]
    return _round(share_segments(data), ["percent", "ymax", "ymin", "labpos"])


# -- orders -------------------------------------------------------------------


def q_running_minutes(spark, sf_dir):
    t = _dedup(spark, sf_dir)
    rows = t.select("ride_id", "started_at", minutes_between("started_at", "ended_at").alias("minutes"))
    return ordered(rows, ["started_at", "ride_id"], totals={"cum_minutes": "minutes"}, lags={"minutes_before": "minutes"})


def _in_order(spark, df, name, order):
    return write_ordered(df, scratch_path(spark, "ordered", name), order)


def q_time_rollup_ordered(spark, sf_dir):
    order = ["year", "month", "weekday", "hour", "type", "member", "rideable_type"]
    return _in_order(spark, time_rollup(_rides(spark, sf_dir)), "time_rollup", order)


def q_time_rollup_legacy_ordered(spark, sf_dir):
    data_time = legacy_report(_legacy_fixed(spark, sf_dir))["data_time"]
    levels = [F.asc("year"), F.asc_nulls_last("month_level"), F.asc_nulls_last("weekday_level")]
    order = [*levels, F.asc("hour_of_day"), F.asc("rideable_type"), F.asc("member_casual")]
    return _in_order(spark, data_time, "time_rollup_legacy", order)


# -- distributions ----------------------------------------------------------


def q_histogram(spark, sf_dir):
    h = histogram(_rides(spark, sf_dir), "duration", HISTOGRAM_WIDTH, by=["member", "rideable_type"])
    return h.withColumn("member_label", member_label("member")).withColumn("bike_label", bike_label("rideable_type"))


def q_histogram_facet(spark, sf_dir):
    h = histogram(_rides(spark, sf_dir), "duration", HISTOGRAM_WIDTH, by=["rideable_type", "member"])
    return h.withColumn("panel", F.concat_ws(" / ", bike_label("rideable_type"), member_label("member")))


def q_boxplot_stats(spark, sf_dir):
    # whole minutes of 2 to 210: a bound on a group's distinct values
    return boxplot_stats(_rides(spark, sf_dir), "duration", ["member", "rideable_type"], method="window")


def q_boxplot_stats_bucketed(spark, sf_dir):
    return boxplot_stats(_rides(spark, sf_dir), "duration", ["member", "rideable_type"], method="bucketed")


def q_boxplot_outliers(spark, sf_dir):
    return boxplot_outliers(_rides(spark, sf_dir), "duration", ["member", "rideable_type"], method="window")


# -- stations, audits, canonical ids ----------------------------------------


def q_station_trips(spark, sf_dir):
    s = legacy_report(_legacy_fixed(spark, sf_dir))["stations"]
    return _round(s, ["lng", "lat"])


def q_station_trips_by_member(spark, sf_dir):
    s = station_trips(_rides(spark, sf_dir), by_member=True, drop_blank=False, min_trips=0)
    return _round(s, ["lng", "lat"])


def q_top_stations(spark, sf_dir):
    s = legacy_report(_legacy_fixed(spark, sf_dir))["stations"]
    return _round(top_stations(s), ["lng", "lat"])


def q_id_conflict_start(spark, sf_dir):
    return conflict_audit(_legacy_trimmed(spark, sf_dir), "start_station_name", "start_station_id", "id")


def q_id_conflict_end(spark, sf_dir):
    return conflict_audit(_legacy_trimmed(spark, sf_dir), "end_station_name", "end_station_id", "id")


def q_name_conflict_start(spark, sf_dir):
    return conflict_audit(
        _legacy_fixed(spark, sf_dir), "start_station_id", "start_station_name", "name", exclude=[PUBLIC_RACK_PATTERN]
    )


def q_name_conflict_end(spark, sf_dir):
    return conflict_audit(
        _legacy_fixed(spark, sf_dir),
        "end_station_id",
        "end_station_name",
        "name",
        exclude=[PUBLIC_RACK_PREFIX, TEMPORARY_SUFFIX],
        how="any",
        detail=True,
    )


def q_name_conflict_end_intended(spark, sf_dir):
    return conflict_audit(
        _legacy_fixed(spark, sf_dir),
        "end_station_id",
        "end_station_name",
        "name",
        exclude=[PUBLIC_RACK_PREFIX, TEMPORARY_SUFFIX],
        how="all",
        detail=True,
    )


def q_distinct_count_null(spark, sf_dir):
    t = _dedup(spark, sf_dir)
    return t.groupBy("start_station_name").agg(
        distinct_count("start_station_id").alias("n_ids_sql"),
        distinct_count("start_station_id", count_null=True).alias("n_ids_r"),
    )


def q_canonical_id_start(spark, sf_dir):
    return canonical_id(_legacy_trimmed(spark, sf_dir), "start_station_name", "start_station_id")


def q_canonical_id_end(spark, sf_dir):
    return canonical_id(_legacy_trimmed(spark, sf_dir), "end_station_name", "end_station_id")


def q_canonical_id_mode(spark, sf_dir):
    return canonical_id(_legacy_trimmed(spark, sf_dir), "start_station_name", "start_station_id", strategy="mode")


def q_canonical_name(spark, sf_dir):
    return canonical_name(
        _legacy_fixed(spark, sf_dir),
        "start_station_id",
        "start_station_name",
        strategy="max",
        exclude=[PUBLIC_RACK_PREFIX, TEMPORARY_SUFFIX],
        how="all",
    )


def q_canonical_name_end(spark, sf_dir):
    return canonical_name(
        _legacy_fixed(spark, sf_dir),
        "end_station_id",
        "end_station_name",
        strategy="max",
        exclude=[PUBLIC_RACK_PREFIX, TEMPORARY_SUFFIX],
        how="all",
    )


def q_station_identity(spark, sf_dir):
    return station_identity(_legacy_trimmed(spark, sf_dir), exclude=[PUBLIC_RACK_PREFIX, TEMPORARY_SUFFIX])


def q_unify_stations(spark, sf_dir):
    return unify_stations(_legacy_trimmed(spark, sf_dir), exclude=[PUBLIC_RACK_PREFIX, TEMPORARY_SUFFIX])


def q_legacy_rides(spark, sf_dir):
    return _legacy_fixed(spark, sf_dir)


def q_legacy_report(spark, sf_dir):
    return legacy_report(_legacy_fixed(spark, sf_dir))["data"]


# -- areas --------------------------------------------------------------------


def q_within_join(spark, sf_dir):
    v = _views(spark, sf_dir)
    pts = station_trips(_rides(spark, sf_dir), by_member=True, drop_blank=False, min_trips=0)
    return _round(within_join(pts, v["areas"]), ["lng", "lat"])


def q_within_join_rides(spark, sf_dir):
    v = _views(spark, sf_dir)
    rides = _rides(spark, sf_dir).select(
        "member", "rideable_type", "duration", "start_station_name", "start_lng", "start_lat"
    )
    return within_join(rides, v["areas"], x="start_lng", y="start_lat")


def q_area_totals(spark, sf_dir):
    v = _views(spark, sf_dir)
    pts = station_trips(_rides_unfiltered(spark, sf_dir), by_member=True, drop_blank=False)
    return area_totals(pts, v["areas"])


def q_area_trips(spark, sf_dir):
    v = _views(spark, sf_dir)
    return area_trips(_rides(spark, sf_dir), v["areas"])


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
