"""Cleaning: the combined delete (F5), duplicate keys (A2, J1, J2, J11), the
null audit (A1) and the cleaning ledger (A25)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelens.operators._plan import salted_join, written_map
from ridelens.operators.predicates import both_blank, delete_where, outside_minutes
from ridelens.schema import CleanParams


def clean_predicates(params: CleanParams = CleanParams()) -> list[Column]:
    """The disjuncts of the main clean (F1-F4): a row is deleted when any is TRUE.

    The reference's ``start_station_name = NULL AND end_station_name = NULL``
    disjunct is never TRUE (F3, D1) and is left out; AND binds before OR (D2).
    """
    return [
        *[F.col(c).isNull() for c in params.required],
        both_blank(),
        *outside_minutes(params.min_minutes_exclusive, params.max_minutes_inclusive),
    ]


def clean_predicate(params: CleanParams = CleanParams()) -> Column:
    """The main clean as a single predicate."""
    preds = clean_predicates(params)
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out


def clean_trips(df: DataFrame, params: CleanParams = CleanParams()) -> DataFrame:
    """One filter pass over the trips (F5). The NULL tests reach the parquet
    scan as pushed ``IsNotNull`` filters."""
    return delete_where(df, *clean_predicates(params))


def _with_collation(df: DataFrame, keys: Sequence[str], collation: str | None) -> tuple[DataFrame, list[str]]:
    if collation is None:
        return df, list(keys)
    out = df
    cols = []
    for k in keys:
        name = f"__k_{k}"
        out = out.withColumn(name, F.collate(F.col(k), collation))
        cols.append(name)
    return out, cols


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("ride_id",), min_count: int = 2) -> DataFrame:
    """Keys held by more than one row: ``GROUP BY key HAVING COUNT(*) > 1`` (A2).

    Partial aggregation runs before the shuffle, so a hot key costs one row per
    map task, not all of its rows.
    """
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") >= min_count)


def drop_all_duplicates(
    df: DataFrame,
    keys: Sequence[str] = ("ride_id",),
    keep: str = "none",
    order_by: Sequence[str] | None = None,
    collation: str | None = None,
    salt_buckets: int | None = None,
) -> DataFrame:
    """Remove *every* copy of a duplicated key (J1, J2, M2); ``keep="one"``
    keeps a single copy instead (D4): the first by ``order_by``, by default by
    all other columns, so that the choice does not depend on the partitioning.
    A row with a NULL key is no copy of another and is kept either way.

    ``keep="none"`` is a left-anti join against the duplicate keys, so a NULL
    key is kept (as ``DELETE ... IN`` keeps it). The duplicate keys are written
    once and read back (``written_map``): when they are few they are broadcast
    and no row of ``df`` is shuffled; otherwise a sort-merge anti join runs with
    skewed left partitions split. ``salt_buckets`` salts the anti join
    explicitly instead (see ``salted_join``), for sessions without adaptive
    skew handling.
    """
    keys = list(keys)
    if keep == "one":
        rest = [c for c in (order_by or df.columns) if c not in keys]
        first = F.min_by(F.struct("*"), F.struct(*rest)) if rest else F.first(F.struct("*"))
        keyless = F.lit(False)
        for k in keys:
            keyless = keyless | F.col(k).isNull()
        kept = df.where(~keyless).groupBy(*keys).agg(first.alias("__row")).select("__row.*")
        return kept.unionByName(df.where(keyless))
    if keep != "none":
        raise ValueError(f"keep must be 'none' or 'one', not {keep!r}")
    if collation is None:
        dups = written_map(duplicate_keys(df, keys).select(*keys), "duplicate_keys")
        if salt_buckets:
            return salted_join(df, dups, keys, "left_anti", salt_buckets)
        return df.join(dups, on=keys, how="left_anti")
    work, kcols = _with_collation(df, keys, collation)
    dups = written_map(work.groupBy(*kcols).count().filter(F.col("count") > 1).drop("count"), "duplicate_keys")
    return work.join(dups, on=kcols, how="left_anti").drop(*kcols)


def keep_in(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is IN the other frame: a left-semi join."""
    return df.join(keys_df.select(*keys), on=list(keys), how="left_semi")


def null_audit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL counts of ``cols`` in one row, ``SUM(CASE ...)`` style: NULL on an
    empty table (A1). One global aggregate, partial per task."""
    return df.agg(
        *[F.sum(F.when(F.col(c).isNull(), F.lit(1)).otherwise(F.lit(0))).alias(f"{c}_nulls") for c in cols]
    )


def cleaning_ledger(steps: Sequence[tuple]) -> DataFrame:
    """Rows in, rows out, rows removed and rows changed by each statement.

    ``steps`` are successive states of one table, first the input, as
    ``(name, frame)`` for a delete or ``(name, frame, flag)`` for an update
    whose boolean column ``flag`` marks the rows it changed. Each step is one
    global aggregate (partial per task); the small results are unioned.
    Nothing is collected.
    """
    parts = []
    for i, step in enumerate(steps):
        name, frame = step[0], step[1]
        flag = step[2] if len(step) > 2 else None
        changed = F.sum(F.col(flag).cast("long")) if flag else F.lit(None).cast("long")
        parts.append(
            frame.agg(F.count(F.lit(1)).alias("rows_out"), changed.alias("changed")).select(
                F.lit(i).alias("step_no"), F.lit(name).alias("step"), "rows_out", "changed"
            )
        )
    ledger = parts[0]
    for p in parts[1:]:
        ledger = ledger.unionByName(p)
    # Each step's input is the previous step's output: an equi-join on the
    # step number, no ordered window.
    previous = ledger.select((F.col("step_no") + 1).alias("step_no"), F.col("rows_out").alias("rows_in"))
    return ledger.join(previous, on="step_no", how="left").select(
        "step_no",
        "step",
        "rows_in",
        "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("removed"),
        "changed",
    )
