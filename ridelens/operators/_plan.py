"""Plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.sources.files import checkpoint_table

# Largest dimension we broadcast without asking the optimizer: a station list
# or a set of polygon edges, never a table that grows with the trips.
DEFAULT_BROADCAST_ROWS = 200_000


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows.

    The proof is a ``limit(max_rows + 1).count()`` job, which stops reading
    once the bound is passed. Above the bound the frame is returned as is and
    the join is planned as a shuffle join (adaptive execution may still turn it
    into a broadcast after measuring the materialised side).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def written_map(df: DataFrame, name: str) -> DataFrame:
    """A key table (one row per key) written once and read back. An aggregate
    joined directly sits on its own exchange, which adaptive execution does not
    split; a scan does: a small map is broadcast from its known size and the
    big side is not shuffled, and beside a large one a crowded key of the big
    side is split over several tasks."""
    return checkpoint_table(df, name)


def scalar_of(agg: DataFrame):
    """The single value of a global aggregate (no grouping keys, so exactly
    one row) as a scalar subquery column: computed once, before the query that
    uses it, and read by every task without any join. Aggregate several
    values into one struct and read its fields; the repeated subquery is
    reused, not recomputed."""
    return agg.scalar()


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], how: str, buckets: int) -> DataFrame:
    """Join ``big`` to ``small`` on ``keys`` with the big side salted.

    Each big row gets a salt from a hash of the whole row (deterministic, so
    a recomputed task after an executor loss gets the same salts); the small
    side, at most one row per key, is copied once per salt. A key holding a
    third of the rows is then spread over ``buckets`` tasks instead of one,
    with the same result as the plain join for inner, left, semi and anti
    joins. Use it where adaptive skew handling is not available.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(buckets)).cast("int")
    salted_big = big.withColumn("__salt", salt)
    salted_small = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted_big.join(salted_small, on=[*keys, "__salt"], how=how).drop("__salt")
