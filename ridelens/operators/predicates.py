"""Row filters with SQL ``DELETE ... WHERE`` semantics.

``DELETE WHERE p`` removes the rows where ``p`` is TRUE and keeps the rows
where it is FALSE *or NULL*, so the Spark form is ``filter(NOT coalesce(p, false))``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelens.functions.scalar import as_col, minutes_between, seconds_between
from ridelens.schema import MAX_TRIP_SECONDS, MIN_TRIP_SECONDS


def keep_unless(predicate: Column) -> Column:
    """TRUE where ``predicate`` is FALSE or NULL."""
    return ~F.coalesce(predicate, F.lit(False))


def delete_where(df: DataFrame, predicate: Column, *more: Column) -> DataFrame:
    """Keep rows where ``predicate`` (OR any of ``more``) is FALSE or NULL (M1).

    ``DELETE WHERE p1 OR p2`` keeps a row exactly when no disjunct is TRUE,
    so the disjuncts are given separately and kept as a conjunction: simple
    ones (``x IS NULL`` becomes ``x IS NOT NULL``) then reach the scan as
    pushed filters instead of hiding inside one opaque expression.
    """
    cond = keep_unless(predicate)
    for p in more:
        cond = cond & keep_unless(p)
    return df.filter(cond)


def any_null(cols: Iterable[str]) -> Column:
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return cond if cond is not None else F.lit(False)


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Reject rows NULL in any of ``cols``."""
    return df.dropna(how="any", subset=list(cols))


def both_blank(a: str = "start_station_name", b: str = "end_station_name") -> Column:
    return (F.col(a) == "") & (F.col(b) == "")


def drop_both_blank(df: DataFrame, a: str = "start_station_name", b: str = "end_station_name") -> DataFrame:
    """Reject rows where both names are '' (one blank is kept) (F2)."""
    return delete_where(df, both_blank(a, b))


def outside_minutes(lo_exclusive: int, hi_inclusive: int, start: str = "started_at", end: str = "ended_at") -> list[Column]:
    minutes = minutes_between(start, end)
    return [minutes <= lo_exclusive, minutes > hi_inclusive]


def duration_between(df: DataFrame, lo: int = 2, hi: int = 210) -> DataFrame:
    """Keep trips of ``lo``..``hi`` whole minutes; NULL spans are kept."""
    return delete_where(df, *outside_minutes(lo - 1, hi))


def exclude_like(df: DataFrame, col: str, patterns: Sequence[str], how: str = "all") -> DataFrame:
    """Keep rows whose ``col`` is NOT LIKE the patterns.

    ``how="all"`` drops a value matching any pattern (the intent);
    ``how="any"`` keeps a value that fails to match at least one pattern (the
    reference's ``NOT LIKE a OR NOT LIKE b``). NULL values are dropped, as a
    WHERE clause drops them.
    """
    conds = [~as_col(col).like(p) for p in patterns]
    cond = conds[0]
    for c in conds[1:]:
        cond = (cond & c) if how == "all" else (cond | c)
    return df.filter(cond)


def drop_non_positive_span(df: DataFrame, start: str = "started_at", end: str = "ended_at") -> DataFrame:
    """Delete trips whose start is not before the end."""
    return delete_where(df, F.col(start) >= F.col(end))


def drop_longer_than(df: DataFrame, seconds: int = MAX_TRIP_SECONDS, start: str = "started_at", end: str = "ended_at") -> DataFrame:
    """Delete trips over ``seconds``."""
    return delete_where(df, seconds_between(start, end) > seconds)


def drop_shorter_than(df: DataFrame, seconds: int = MIN_TRIP_SECONDS, start: str = "started_at", end: str = "ended_at") -> DataFrame:
    """Delete trips under ``seconds``."""
    return delete_where(df, seconds_between(start, end) < seconds)


def min_trips(df: DataFrame, n: int = 0, col: str = "n_trips") -> DataFrame:
    """Keep groups with more than ``n`` trips."""
    return df.filter(F.col(col) > n)
