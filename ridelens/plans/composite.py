"""The reference's composite steps as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelens.functions.scalar import to_minutes
from ridelens.operators._plan import scalar_of
from ridelens.operators.clean import clean_predicates, clean_trips, drop_all_duplicates
from ridelens.operators.conform import canonical_id, conform_station, conform_stations
from ridelens.operators.derive import derive_rides, derive_rides_legacy, narrow, type_timestamps, type_trips
from ridelens.operators.geo import area_totals
from ridelens.operators.outliers import drop_zscore
from ridelens.operators.predicates import drop_missing
from ridelens.operators.rollup import od_rollup, station_trips, time_rollup, time_rollup_legacy
from ridelens.schema import LEGACY_REQUIRED_COLUMNS, CleanParams, ZScoreParams
from ridelens.sources.files import checkpoint_table


def clean_trips_table(
    trips_raw: DataFrame,
    stations_raw: DataFrame | None = None,
    params: CleanParams = CleanParams(),
) -> DataFrame:
    """Type timestamps, clean, drop duplicated keys, conform start stations.

    Cleaning runs before duplicate removal, as in the reference, so a key
    whose twin was cleaned away survives.
    """
    typed = type_timestamps(trips_raw)
    cleaned = clean_trips(typed, params)
    deduped = drop_all_duplicates(cleaned, ["ride_id"])
    if stations_raw is not None:
        deduped = conform_station(deduped, conform_stations(stations_raw), side="start")
    return deduped


def rides_narrow(
    trips_raw: DataFrame,
    stations_raw: DataFrame | None = None,
    params: CleanParams = CleanParams(),
    materialize: bool = True,
) -> DataFrame:
    """C1, derive, narrow: the analysis table before the outlier cut.

    ``materialize=True`` writes it once to the checkpoint folder. The z-score
    reads its input twice (statistics, then the filter) and the duplicate-key
    side of the anti join reads the trips again, so without the copy the
    scan, clean and anti join would run three or four times.
    """
    rides = narrow(derive_rides(clean_trips_table(trips_raw, stations_raw, params)))
    return checkpoint_table(rides, "rides_narrow") if materialize else rides


def analysis_rides(
    trips_raw: DataFrame,
    stations_raw: DataFrame | None = None,
    params: CleanParams = CleanParams(),
    z: ZScoreParams = ZScoreParams(),
    materialize: bool = True,
) -> DataFrame:
    """C1, derive, narrow, z-score cut on minutes."""
    return drop_outliers(rides_narrow(trips_raw, stations_raw, params, materialize), z)


def drop_outliers(rides: DataFrame, z: ZScoreParams = ZScoreParams()) -> DataFrame:
    """The z-score cut of C2 over rides that are already derived."""
    return drop_zscore(rides, "duration", k=z.k, sd=z.sd, strict=z.strict)


def rollups(rides: DataFrame) -> dict[str, DataFrame]:
    """The two rollups built from the rides."""
    return {"time_rollup": time_rollup(rides), "od_rollup": od_rollup(rides)}


def _ledger(counts: DataFrame, steps: list[tuple]) -> DataFrame:
    """A25 from one row of counts: per step its number, name, rows in and out,
    rows removed and rows changed. A step is (name, rows column) or (name, rows
    column, changed column)."""
    none = F.lit(None).cast("long")
    rows = []
    for i, step in enumerate(steps):
        rows_in = F.col(steps[i - 1][1]) if i else none
        rows_out = F.col(step[1])
        rows.append(
            F.struct(
                F.lit(i).alias("step_no"),
                F.lit(step[0]).alias("step"),
                rows_in.alias("rows_in"),
                rows_out.alias("rows_out"),
                (rows_in - rows_out).alias("removed"),
                (F.col(step[2]) if len(step) > 2 else none).alias("changed"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def _singles(n: Column, rows: Column, key: str = "ride_id") -> Column:
    """Rows left of a key's rows when every duplicated key is removed: a NULL
    key is no duplicate, and a key stays when it has one row."""
    return F.sum(F.when(F.col(key).isNull() | (n == 1), rows).otherwise(0))


def _clean_counts(typed: DataFrame, params: CleanParams) -> DataFrame:
    """load, clean and drop_duplicates rows of the main script, in one scan."""
    preds = clean_predicates(params)
    deleted = preds[0]
    for p in preds[1:]:
        deleted = deleted | p
    kept = (~F.coalesce(deleted, F.lit(False))).cast("long")
    per_key = typed.groupBy("ride_id").agg(F.count(F.lit(1)).alias("n"), F.sum(kept).alias("kept"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("load"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("clean"),
        F.coalesce(_singles(F.col("kept"), F.col("kept")), F.lit(0)).alias("drop_duplicates"),
    )


def _rows(df: DataFrame):
    return scalar_of(df.agg(F.count(F.lit(1))))


def clean_ledger(trips_raw: DataFrame, params: CleanParams = CleanParams(), materialize: bool = True) -> DataFrame:
    """A25 over C2: rows in and out of each deleting step. The steps before
    the z-score cut are one aggregate per key over one scan of the trips."""
    typed = type_timestamps(trips_raw)
    deduped = drop_all_duplicates(clean_trips(typed, params), ["ride_id"])
    rides = narrow(derive_rides(deduped))
    if materialize:
        rides = checkpoint_table(rides, "rides_narrow")
    counts = _clean_counts(typed, params).withColumn("zscore", _rows(drop_zscore(rides, "duration")))
    return _ledger(counts, [(name, name) for name in ("load", "clean", "drop_duplicates", "zscore")])


def statement_ledger(
    trips_raw: DataFrame, stations_raw: DataFrame, params: CleanParams = CleanParams(), materialize: bool = True
) -> DataFrame:
    """A25 over the main script's statements in order: load, clean, drop
    duplicated keys, conform start stations (rows changed), z-score cut;
    the counts its comments record."""
    typed = type_timestamps(trips_raw)
    deduped = drop_all_duplicates(clean_trips(typed, params), ["ride_id"])
    conformed = conform_station(deduped, conform_stations(stations_raw), side="start", mark_changes="__changed")
    flagged = conformed.select("*", F.col("__changed").alias("flag"))
    rides = narrow(derive_rides(flagged, also=("flag",)))
    if materialize:
        rides = checkpoint_table(rides, "rides_narrow")
    changed = rides.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col("flag").cast("long")).alias("changed")))
    counts = _clean_counts(typed, params).select(
        "*", scalar_of(changed).alias("conform"), _rows(drop_zscore(rides, "duration")).alias("zscore")
    )
    counts = counts.select("*", F.col("conform.n").alias("conformed"), F.col("conform.changed").alias("changed"))
    return _ledger(
        counts,
        [
            ("load", "load"),
            ("clean", "clean"),
            ("drop_duplicates", "drop_duplicates"),
            ("conform_stations", "conformed", "changed"),
            ("zscore", "zscore"),
        ],
    )


def legacy_ledger(trips_raw: DataFrame, materialize: bool = True) -> DataFrame:
    """A25 over the legacy script's statements in order: load, drop
    duplicated keys, drop missing values, z-score cut on seconds, then the
    rows rewritten by the start-id and end-id updates."""
    typed = type_trips(trips_raw.drop("source_month") if "source_month" in trips_raw.columns else trips_raw)
    legacy = legacy_derived(trips_raw, materialize)
    missing = F.lit(False)
    for c in LEGACY_REQUIRED_COLUMNS:
        missing = missing | F.col(c).isNull()
    per_key = typed.groupBy("ride_id").agg(F.count(F.lit(1)).alias("n"), F.sum((~missing).cast("long")).alias("complete"))
    trimmed = drop_zscore(legacy, "trip_duration")
    start = canonical_id(trimmed, "start_station_name", "start_station_id", mark_changes="__start_changed")
    both = canonical_id(start, "end_station_name", "end_station_id", mark_changes="__end_changed")
    changes = both.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("__start_changed").cast("long")).alias("start"),
            F.sum(F.col("__end_changed").cast("long")).alias("end"),
        )
    )
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("load"),
        F.coalesce(_singles(F.col("n"), F.col("n")), F.lit(0)).alias("deduped"),
        F.coalesce(_singles(F.col("n"), F.col("complete")), F.lit(0)).alias("complete"),
    ).select("*", scalar_of(changes).alias("c"))
    counts = counts.select("load", "deduped", "complete", "c.n", "c.start", "c.end")
    return _ledger(
        counts,
        [
            ("load", "load"),
            ("drop_duplicates", "deduped"),
            ("drop_missing", "complete"),
            ("zscore", "n"),
            ("start_ids", "n", "start"),
            ("end_ids", "n", "end"),
        ],
    )


def legacy_derived(trips_raw: DataFrame, materialize: bool = True) -> DataFrame:
    """C4 up to the derivation: type, drop duplicated keys, drop missing
    values, derive seconds and labels. Duplicates are removed *before* the
    missing-value delete here."""
    typed = type_trips(trips_raw.drop("source_month") if "source_month" in trips_raw.columns else trips_raw)
    deduped = drop_all_duplicates(typed, ["ride_id"])
    complete = drop_missing(deduped, LEGACY_REQUIRED_COLUMNS)
    legacy = derive_rides_legacy(complete)
    return checkpoint_table(legacy, "legacy_derived") if materialize else legacy


def legacy_rides(trips_raw: DataFrame, fix_ids: bool = True, materialize: bool = True) -> DataFrame:
    """C4: legacy derivation, z-score cut on seconds, canonical start and end
    ids (each a per-name map joined back on the name)."""
    trimmed = trim_legacy(legacy_derived(trips_raw, materialize))
    return fix_station_ids(trimmed) if fix_ids else trimmed


def trim_legacy(derived: DataFrame) -> DataFrame:
    """The z-score cut of C4 over a derived legacy table."""
    return drop_zscore(derived, "trip_duration")


def fix_station_ids(legacy: DataFrame) -> DataFrame:
    """The two id rewrites of C4."""
    fixed = canonical_id(legacy, "start_station_name", "start_station_id", strategy="max")
    return canonical_id(fixed, "end_station_name", "end_station_id", strategy="max")


def legacy_report(legacy: DataFrame) -> dict[str, DataFrame]:
    """The report's three frames over the legacy table.

    ``data``: positive seconds, rounded half to even to minutes, R z-score
    (sample SD, strict). ``stations``: trips and mean position per start
    station (NA in a mean gives NA, as R's mean does). ``data_time``: A6.
    """
    data = (
        legacy.select("rideable_type", "member_casual", "trip_duration")
        .filter(F.col("trip_duration") > 0)
        .withColumn("trip_duration", to_minutes("trip_duration", "half_even"))
    )
    data = drop_zscore(data, "trip_duration", k=3.0, sd="samp", strict=True)
    return {
        "data": data,
        "stations": station_trips(legacy, by_member=False, drop_blank=True, na_rm=False).drop("n_trips_k"),
        "data_time": time_rollup_legacy(legacy),
    }


def area_trips(rides: DataFrame, areas: DataFrame) -> DataFrame:
    """Station rollup -> within-join -> trips per area, zero filled."""
    stations = station_trips(rides, by_member=True, drop_blank=False, min_trips=0)
    return area_totals(stations, areas)
