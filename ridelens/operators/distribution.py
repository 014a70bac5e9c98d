"""Histogram and box-plot statistics.

The histogram bins rows in place and aggregates once by (group, bin). The box
plot starts from a value-count table, ``groupBy(by + [x]).count()``: one pass
over the rows with partial aggregation, after which everything runs on at most
one row per distinct value per group. For whole-minute durations that is a few
hundred rows per group, whatever the number of trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelens.operators._plan import scalar_of
from ridelens.schema import BOX_NOTCH_FACTOR, BOX_WHISKER_COEF, HISTOGRAM_WIDTH


def value_counts(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("__n"))


def histogram(df: DataFrame, col: str = "duration", width: float = HISTOGRAM_WIDTH, by: Sequence[str] = ()) -> DataFrame:
    """Counts per bin of ``width``.

    Bins are right-closed, ``(c - w/2, c + w/2]``, with centres on multiples
    of ``width`` (a boundary at ``width/2``); the lowest bin also takes its
    lower edge (T10), which is where the global minimum goes when it sits
    exactly on an edge. Only non-empty bins are returned.

    Each row is binned in place against the minimum (a scalar subquery) and
    the counts are aggregated once by (group, bin): partial aggregation
    leaves a few hundred rows per task whatever the number of trips or of
    distinct values.
    """
    lowest = scalar_of(df.agg(F.min(F.col(col).cast("double"))))
    x = F.col(col).cast("double")
    w = float(width)
    centre = F.ceil((x - w / 2.0) / w) * w
    on_lowest_edge = (x == lowest) & (((x - w / 2.0) / w) == F.floor((x - w / 2.0) / w))
    centre = F.when(on_lowest_edge, x + w / 2.0).otherwise(centre)
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(*by, centre.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("xmin", F.col("bin") - w / 2.0)
        .withColumn("xmax", F.col("bin") + w / 2.0)
    )


_PROBS = (0.25, 0.5, 0.75)


def bucketed_quantiles(
    vc: DataFrame,
    by: list[str],
    col: str,
    probs: tuple[float, ...] = _PROBS,
    buckets: int = 1024,
    accuracy: int = 10000,
) -> DataFrame:
    """Exact linear-interpolation quantiles (type 7) per group from a
    (group, value, count) table, without gathering a group in one task.

    1. ``percentile_approx`` over each group's distinct values gives
       ``buckets - 1`` boundaries (a bounded sketch, partially aggregated);
       they only place values in buckets, so they cannot change the result.
    2. Bucket totals and their running offsets per group (at most ``buckets``
       rows per group).
    3. The two sorted positions around each quantile, ``floor(h)`` and the
       next one with ``h = (n - 1) p``, locate their buckets.
    4. Only those buckets' values are ranked, by a window partitioned by
       (group, bucket): about distinct values / ``buckets`` per task.

    Returns one row per group with ``n`` and ``__q``, an array of the
    quantiles in ``probs`` order.
    """
    x = F.col(col).cast("double")
    keys = list(by)
    if not keys:
        vc, keys = vc.withColumn("__all", F.lit(0)), ["__all"]
    cuts = F.array(*[F.lit(k / buckets) for k in range(1, buckets)])
    bounds = vc.groupBy(*keys).agg(F.percentile_approx(x, cuts, accuracy).alias("__bounds"))
    placed = (
        vc.join(bounds, on=keys, how="inner")
        .withColumn("__bucket", F.size(F.filter("__bounds", lambda b: b < x)))
        .drop("__bounds")
    )

    gw = Window.partitionBy(*keys)
    totals = placed.groupBy(*keys, "__bucket").agg(F.sum("__n").alias("__tot"))
    totals = totals.withColumn(
        "__before", F.coalesce(F.sum("__tot").over(gw.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("__size", F.sum("__tot").over(gw))

    # Target positions per group: for each p, floor(h) and min(floor(h) + 1, n - 1).
    pos = []
    for j, p in enumerate(probs):
        h = (F.col("__size") - 1) * F.lit(p)
        lo = F.floor(h)
        pos.append(F.struct(F.lit(2 * j).alias("slot"), lo.alias("rank")))
        pos.append(F.struct(F.lit(2 * j + 1).alias("slot"), F.least(lo + 1, F.col("__size") - 1).alias("rank")))
    targets = (
        totals.select(*keys, "__bucket", "__before", "__tot", F.explode(F.array(*pos)).alias("t"))
        .filter((F.col("t.rank") >= F.col("__before")) & (F.col("t.rank") < F.col("__before") + F.col("__tot")))
        .select(*keys, "__bucket", "__before", F.col("t.slot").alias("slot"), F.col("t.rank").alias("rank"))
    )
    wanted = targets.select(*keys, "__bucket", "__before").distinct()
    bw = Window.partitionBy(*keys, "__bucket").orderBy(col)
    ranked = (
        placed.join(wanted, on=[*keys, "__bucket"], how="inner")
        .withColumn("__start", F.col("__before") + F.sum("__n").over(bw.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("__start", F.coalesce(F.col("__start"), F.col("__before")))
    )
    hits = ranked.join(targets.drop("__before"), on=[*keys, "__bucket"], how="inner").filter(
        (F.col("rank") >= F.col("__start")) & (F.col("rank") < F.col("__start") + F.col("__n"))
    )
    per_group = hits.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("slot", x))).alias("__v"))
    sizes = totals.groupBy(*keys).agg(F.max("__size").alias("n"))
    qs = []
    for j, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(p)
        frac = h - F.floor(h)
        lo_v, hi_v = F.col("__v")[2 * j], F.col("__v")[2 * j + 1]
        qs.append(lo_v + frac * (hi_v - lo_v))
    out = per_group.join(sizes, on=keys, how="inner").select(*keys, "n", F.array(*qs).alias("__q"))
    return out.drop("__all") if keys == ["__all"] else out


def _with_quartiles(df: DataFrame, col: str, by: list[str], method: str, accuracy: int) -> DataFrame:
    """Value counts with the group's quartiles on every row.

    ``method="window"`` (exact): ``percentile(x, p, count)`` evaluated as a
    window over the value counts of each group, so the rows are aggregated
    once and a group costs one row per distinct value, however many trips it
    holds. That is a proven bound for ride durations: after the main clean
    they are whole minutes in 2..210, so a group has at most 209 distinct
    values. ``method="bucketed"`` (exact): ``bucketed_quantiles``, for
    columns without such a bound. ``method="approx"``: ``percentile_approx``
    (bounded sketches, partial aggregation) over the rows.
    """
    probs = F.array(*[F.lit(p) for p in _PROBS])
    x = F.col(col).cast("double")
    vc = value_counts(df, col, by)
    if method == "approx":
        q = df.filter(F.col(col).isNotNull()).groupBy(*by).agg(
            F.percentile_approx(x, probs, accuracy).alias("__q")
        )
        out = vc.join(q, on=by, how="inner") if by else vc.withColumn("__q", scalar_of(q.select("__q")))
    elif method == "bucketed":
        q = bucketed_quantiles(vc, list(by), col, accuracy=accuracy).drop("n")
        out = vc.join(q, on=by, how="inner") if by else vc.withColumn("__q", scalar_of(q.select("__q")))
    elif method == "window":
        w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        out = vc.withColumn("__q", F.percentile(x, probs, F.col("__n")).over(w))
    else:
        raise ValueError(f"method must be 'window', 'bucketed' or 'approx', not {method!r}")
    return out.select(
        "*",
        F.col("__q")[0].alias("lower"),
        F.col("__q")[1].alias("middle"),
        F.col("__q")[2].alias("upper"),
    ).drop("__q")


def boxplot_stats(
    df: DataFrame,
    col: str = "duration",
    by: Sequence[str] = ("member", "rideable_type"),
    coef: float = BOX_WHISKER_COEF,
    approx: bool = False,
    accuracy: int = 10000,
    method: str | None = None,
) -> DataFrame:
    """Five-number summary per group as a box plot draws it.

    Quartiles interpolate linearly (type 7); whiskers are the furthest values
    within ``coef`` IQR of the box; ``n_outliers`` counts the rest; notches
    are median +- BOX_NOTCH_FACTOR IQR / sqrt(n). ``method`` picks how the
    quartiles are found (see ``_with_quartiles``); ``approx=True`` is
    ``method="approx"``.
    """
    by = list(by)
    vq = _with_quartiles(df, col, by, method or ("approx" if approx else "bucketed"), accuracy)
    x = F.col(col).cast("double")
    iqr = F.col("upper") - F.col("lower")
    lo_fence = F.col("lower") - coef * iqr
    hi_fence = F.col("upper") + coef * iqr
    stats = vq.groupBy(*by).agg(
        F.sum("__n").alias("n"),
        F.min(F.when(x >= lo_fence, x)).alias("ymin"),
        F.any_value("lower").alias("lower"),
        F.any_value("middle").alias("middle"),
        F.any_value("upper").alias("upper"),
        F.max(F.when(x <= hi_fence, x)).alias("ymax"),
        F.sum(F.when((x < lo_fence) | (x > hi_fence), F.col("__n")).otherwise(F.lit(0))).alias("n_outliers"),
    )
    box_iqr = F.col("upper") - F.col("lower")
    return stats.select(
        *by,
        "n",
        "ymin",
        "lower",
        "middle",
        "upper",
        "ymax",
        (F.col("middle") - BOX_NOTCH_FACTOR * box_iqr / F.sqrt(F.col("n"))).alias("notchlower"),
        (F.col("middle") + BOX_NOTCH_FACTOR * box_iqr / F.sqrt(F.col("n"))).alias("notchupper"),
        "n_outliers",
    )


def boxplot_outliers(
    df: DataFrame,
    col: str = "duration",
    by: Sequence[str] = ("member", "rideable_type"),
    coef: float = BOX_WHISKER_COEF,
    approx: bool = False,
    accuracy: int = 10000,
    method: str | None = None,
) -> DataFrame:
    """The outliers of each box, as (group, value, count): every outlying row
    is represented, multiplicity included, without moving the rows (A23)."""
    by = list(by)
    vq = _with_quartiles(df, col, by, method or ("approx" if approx else "bucketed"), accuracy)
    x = F.col(col).cast("double")
    iqr = F.col("upper") - F.col("lower")
    return vq.filter((x < F.col("lower") - coef * iqr) | (x > F.col("upper") + coef * iqr)).select(
        *by, F.col(col).alias("value"), F.col("__n").alias("n")
    )
