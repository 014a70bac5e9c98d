"""Shares of a total and within groups.

These run on aggregates (segment counts, time rollups), never on row-level
trips. A window with an empty partition spec moves its input to one task, so
``share_of_total`` divides by a scalar-subquery total instead, and the
running sum of ``share_segments`` is over the six segment rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelens.functions.scalar import segment_label_raw
from ridelens.operators._plan import scalar_of
from ridelens.operators.ordered import ordered


def share_of_total(df: DataFrame, n: str = "n_trips", out: str = "percent") -> DataFrame:
    """n / total * 100 (W1); the total is a global aggregate read as a scalar subquery."""
    total = scalar_of(df.agg(F.sum(n)))
    return df.withColumn(out, F.try_divide(F.col(n).cast("double"), total.cast("double")) * 100.0)


def share_within(df: DataFrame, n: str, by: Sequence[str], out: str = "percentage", digits: int | None = 2) -> DataFrame:
    """n / sum(n) over ``by`` * 100, rounded half to even.
    A zero total gives NULL instead of failing."""
    w = Window.partitionBy(*by)
    pct = F.try_divide(F.col(n).cast("double"), F.sum(n).over(w).cast("double")) * 100.0
    return df.withColumn(out, F.bround(pct, digits) if digits is not None else pct)


def r_number_text(c):
    """A double printed as R's paste0 prints it for these values ('12.5', '12')."""
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def share_segments(legacy: DataFrame) -> DataFrame:
    """Pie-chart frame (W1-W4, P14, O2): trips by member and bike from the raw
    strings, labelled, ordered by label descending (NA last), with percent,
    running ``ymax``, lagged ``ymin``, label position and label text."""
    counts = legacy.groupBy("member_casual", "rideable_type").agg(F.count(F.lit(1)).alias("n_trips"))
    counts = counts.withColumn("type", segment_label_raw("member_casual", "rideable_type"))
    counts = share_of_total(counts, "n_trips", "percent")
    # At most (members x bike kinds) rows: one ordered window is cheap here.
    order = [F.desc_nulls_last("type"), F.asc_nulls_first("member_casual"), F.asc_nulls_first("rideable_type")]
    w = Window.orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = (
        counts.withColumn("pct_label", F.bround("percent", 2))
        .withColumn("ymax", F.sum("percent").over(running))
        .withColumn("ymin", F.lag("ymax", 1, 0.0).over(w))
        .withColumn("labpos", (F.col("ymax") + F.col("ymin")) / 2.0)
        .withColumn("label", F.concat(F.col("type"), F.lit("\n"), r_number_text(F.col("pct_label")), F.lit(" %")))
        .withColumn("position", F.row_number().over(w))
    )
    return out


def cumulative(df: DataFrame, col: str, order: Sequence, out: str | None = None, before: str | None = None) -> DataFrame:
    """Running total of ``col`` in ``order`` (W2) and, in ``before``, the total
    of the rows before (W3), over a frame of any size: range partitions and
    their totals, no window over the whole frame."""
    return ordered(df, order, position=None, totals={out or f"cum_{col}": col}, lags={before: col} if before else None)
