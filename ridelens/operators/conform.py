"""Station conformance, key-pair audits and canonical ids/names
(P1, J5-J7, M3, M4, A16-A21).

The dimension side of every join here is small (one row per station name or
id); it is broadcast after a row-count proof, or left to adaptive execution
when it is an aggregate of the trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelens.operators._plan import broadcast_if_bounded, salted_join, written_map
from ridelens.operators.predicates import exclude_like


def conform_stations(raw: DataFrame) -> DataFrame:
    """Station list to ``s_name, s_id, lat FLOAT, lng FLOAT`` (P1): rename four
    columns, drop four; any other column is kept."""
    renamed = raw.withColumnsRenamed(
        {"Station Name": "s_name", "Short Name": "s_id", "Latitude": "lat", "Longitude": "lng"}
    )
    renamed = renamed.drop("ID", "Total Docks", "Docks in Service", "Status")
    return renamed.withColumn("lat", F.col("lat").cast("float")).withColumn("lng", F.col("lng").cast("float"))


def unique_stations(stations: DataFrame, collation: str | None = None) -> DataFrame:
    """One row per name (T14): the row with a NULL short name first, then the
    smallest (s_id, lat, lng). With ``collation`` names equal under it count
    as one name, so a case-insensitive join cannot fan out."""
    pick = F.min(
        F.struct(
            F.col("s_id").isNotNull().alias("has_id"),
            F.col("s_id").alias("s_id"),
            F.col("lat").alias("lat"),
            F.col("lng").alias("lng"),
            F.col("s_name").alias("s_name"),
        )
    ).alias("w")
    key = F.col("s_name") if collation is None else F.collate(F.col("s_name"), collation)
    return stations.filter(F.col("s_name").isNotNull()).groupBy(key.alias("__key")).agg(pick).select(
        F.col("w.s_name").alias("s_name"),
        F.col("w.s_id").alias("s_id"),
        F.col("w.lat").alias("lat"),
        F.col("w.lng").alias("lng"),
    )


def conform_station(
    trips: DataFrame,
    stations: DataFrame,
    side: str = "start",
    collation: str | None = None,
    max_broadcast_rows: int = 200_000,
    mark_changes: str | None = None,
    salt_buckets: int | None = None,
) -> DataFrame:
    """UPDATE trips JOIN stations ON name.

    For a matching name the trip's name, id, lat and lng are overwritten with
    the station's, *even with NULL* (T5); other trips are unchanged. The
    station side is unique by name, so no trip is duplicated, and it is
    broadcast: the trips are never shuffled. Above ``max_broadcast_rows`` the
    join is a shuffle join on the name, salted when ``salt_buckets`` is given.
    """
    name, sid, lat, lng = (f"{side}_station_name", f"{side}_station_id", f"{side}_lat", f"{side}_lng")
    dim = unique_stations(stations, collation).select(
        F.col("s_name").alias("__s_name"),
        F.col("s_id").alias("__s_id"),
        F.col("lat").alias("__s_lat"),
        F.col("lng").alias("__s_lng"),
        F.lit(True).alias("__matched"),
    )
    dim = broadcast_if_bounded(written_map(dim, "stations"), max_broadcast_rows)
    if collation is None:
        cond = F.col(name) == F.col("__s_name")
    else:
        cond = F.collate(F.col(name), collation) == F.collate(F.col("__s_name"), collation)
    if salt_buckets and collation is None:
        keyed = dim.withColumn(name, F.col("__s_name"))
        joined = salted_join(trips, keyed, [name], "left", salt_buckets)
        # salted_join keeps the trip's name column; the dimension's copy is __s_name.
    else:
        joined = trips.join(dim, cond, "left")
    matched = F.col("__matched").isNotNull()
    types = dict(trips.dtypes)
    sources = {name: "__s_name", sid: "__s_id", lat: "__s_lat", lng: "__s_lng"}
    cols = []
    for c in trips.columns:
        src = sources.get(c)
        if src is None:
            cols.append(F.col(c))
        else:
            cols.append(F.when(matched, F.col(src).cast(types[c])).otherwise(F.col(c)).alias(c))
    if mark_changes:
        # Rows the UPDATE changes: matched and some value differs (NULL-safe).
        differs = [~F.col(c).eqNullSafe(F.col(src).cast(types[c])) for c, src in sources.items()]
        any_diff = differs[0]
        for d in differs[1:]:
            any_diff = any_diff | d
        cols.append((matched & any_diff).alias(mark_changes))
    return joined.select(*cols)


def pair_counts(df: DataFrame, a: str, b: str, out: str = "n_trips") -> DataFrame:
    """Trips by (a, b) (A16). Partial aggregation before the shuffle."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias(out))


def distinct_count(c: Column | str, count_null: bool = False) -> Column:
    """COUNT(DISTINCT c) ignores NULL; R's n_distinct counts NA as a value."""
    c = F.col(c) if isinstance(c, str) else c
    n = F.count_distinct(c)
    if count_null:
        n = n + F.max(F.when(c.isNull(), F.lit(1)).otherwise(F.lit(0)))
    return n


def _rank_key(n: Column, value: Column, descending: bool) -> Column:
    # which.max / which.min return the first row of the group on a tie; the
    # pair rows arrive sorted by value with NULL first.
    return F.struct((-n if descending else n).alias("n"), value.isNotNull().alias("nn"), value.alias("v"))


def arg_max(value: Column | str, n: Column | str) -> Column:
    """Value with the largest ``n``; first (NULL, then smallest) value on a tie."""
    value = F.col(value) if isinstance(value, str) else value
    n = F.col(n) if isinstance(n, str) else n
    return F.min_by(value, _rank_key(n, value, descending=True))


def arg_min(value: Column | str, n: Column | str) -> Column:
    """Value with the smallest ``n``; first value on a tie."""
    value = F.col(value) if isinstance(value, str) else value
    n = F.col(n) if isinstance(n, str) else n
    return F.min_by(value, _rank_key(n, value, descending=False))


def conflict_audit(
    df: DataFrame,
    key: str,
    value: str,
    noun: str,
    exclude: Sequence[str] | None = None,
    how: str = "all",
    detail: bool = False,
) -> DataFrame:
    """Keys with more than one distinct value, with the most and least popular
    value (A17-A19).

    ``key``/``value`` = name/id gives the id audit, id/name the name audit.
    ``exclude`` patterns are applied to the name column first (F10/F11).
    ``detail=True`` keeps one row per (key, value) pair with its own count,
    as the reference's per-row ``count_trips`` does.
    """
    src = df
    if exclude:
        name_col = key if noun == "id" else value
        src = exclude_like(src, name_col, exclude, how=how)
    pairs = pair_counts(src, key, value)
    if not detail:
        return pairs.groupBy(key).agg(
            distinct_count(value, count_null=True).alias(f"n_distinct_{noun}s"),
            arg_max(value, "n_trips").alias(f"most_popular_{noun}"),
            arg_min(value, "n_trips").alias(f"less_popular_{noun}"),
        ).filter(F.col(f"n_distinct_{noun}s") > 1)
    # Pairs are unique per (key, value), so the group statistics are window
    # aggregates over them: one shuffle by key and no join back.
    w = Window.partitionBy(key)
    return (
        pairs.select(
            key,
            F.count(F.lit(1)).over(w).alias(f"n_distinct_{noun}s"),
            value,
            F.col("n_trips").alias("count_trips"),
            arg_max(value, "n_trips").over(w).alias(f"most_popular_{noun}"),
            arg_min(value, "n_trips").over(w).alias(f"less_popular_{noun}"),
        )
        .filter(F.col(f"n_distinct_{noun}s") > 1)
    )


def _main_value(df: DataFrame, key: str, value: str, strategy: str, skip_blank: bool, key_col: str | None = None) -> DataFrame:
    src = df.filter(F.col(key) != "") if skip_blank else df
    key_col = key_col or key
    if strategy == "max":
        return src.groupBy(key_col).agg(F.max(value).alias("__main"))
    if strategy == "mode":
        pairs = pair_counts(src.filter(F.col(value).isNotNull()), key_col, value)
        return pairs.groupBy(key_col).agg(arg_max(value, "n_trips").alias("__main"))
    raise ValueError(f"strategy must be 'max' or 'mode', not {strategy!r}")


def canonical_id(
    df: DataFrame,
    name: str = "start_station_name",
    id_col: str = "start_station_id",
    strategy: str = "max",
    skip_blank: bool = False,
    collation: str | None = None,
    mark_changes: str | None = None,
    salt_buckets: int | None = None,
) -> DataFrame:
    """Set each trip's id to its name's canonical id where it differs.

    ``strategy="max"`` is the reference's ``MAX(id)``; ``"mode"`` the most
    common id its comment describes (D15). A NULL id, a NULL name and a name
    without a non-NULL id stay as they are. The name -> id map has one row per
    name; it is written once, joined on the name, and broadcast when small
    (``written_map``). ``collation`` (e.g. ``"UTF8_LCASE"``) groups names the way a
    case-insensitive server collation would (T6). ``mark_changes`` adds a
    boolean column naming the rows the UPDATE rewrites. ``salt_buckets``
    salts the join to the name map (see ``salted_join``).
    """
    if collation is not None:
        work = df.withColumn("__name_key", F.collate(F.col(name), collation))
        main = written_map(_main_value(work, name, id_col, strategy, skip_blank, key_col="__name_key"), "canonical_ids")
        joined = work.join(main, on="__name_key", how="left")
    else:
        main = written_map(_main_value(df, name, id_col, strategy, skip_blank), "canonical_ids")
        if salt_buckets:
            joined = salted_join(df, main, [name], "left", salt_buckets)
        else:
            joined = df.join(main, on=name, how="left")
    rewrite = F.coalesce(F.col(id_col) != F.col("__main"), F.lit(False))
    fixed = F.when(rewrite, F.col("__main")).otherwise(F.col(id_col))
    extra = [rewrite.alias(mark_changes)] if mark_changes else []
    return joined.select(*[fixed.alias(c) if c == id_col else F.col(c) for c in df.columns], *extra)


def canonical_name(
    df: DataFrame,
    id_col: str = "start_station_id",
    name: str = "start_station_name",
    strategy: str = "max",
    exclude: Sequence[str] | None = None,
    how: str = "all",
) -> DataFrame:
    """Set each trip's name to its id's canonical name (J7; disabled in the
    reference's main flow). ``exclude`` keeps names matching the patterns out of
    the choice of the canonical name."""
    src = exclude_like(df, name, exclude, how=how) if exclude else df
    main = written_map(_main_value(src, id_col, name, strategy, skip_blank=False), "canonical_names")
    joined = df.join(main, on=id_col, how="left")
    fixed = F.when(F.col(name) != F.col("__main"), F.col("__main")).otherwise(F.col(name))
    return joined.select(*[fixed.alias(c) if c == name else F.col(c) for c in df.columns])
