"""State by month that merges: partial aggregates and sketches (A3, A4, A5, A21,
A23, C3), and the reload of one month (S5).

A month's state depends on that month's rides only, so a new or corrected month
recomputes itself alone and the frames are merged from the stored states, whose
size does not grow with the number of trips.

The time state counts rides by calendar keys, segment and duration. The z-score
cut depends on a ride's duration and on the mean and SD of all of them, which are
exact sums over these counts; so the cut is applied after merging and the merged
rollup equals the one computed from all rides, whatever months came later.
Duplicated ride ids are removed before the state is made, within the month: all
copies of a ride start in the same one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.functions.scalar import segment_label
from ridelens.schema import ZScoreParams
from ridelens.session import delete_path

MONTH = "source_month"
TIME_STATE = ["year", "month", "weekday", "hour", "member", "rideable_type", "duration"]
#: Twice the standard error of an HLL sketch of 2^12 registers, and the rank
#: error of a KLL sketch of k = 200, both as their library states them.
HLL_LG, HLL_BOUND = 12, 2 * 1.04 / 2**6
KLL_K, KLL_BOUND = 200, 0.0133


def replace_months(df: DataFrame, path: str, months: Sequence[str], month_col: str = MONTH) -> None:
    """Put the rows of ``months`` in the place of those months' rows in the
    table at ``path``; other months' files are not touched. New files are
    written aside and moved when all of them are complete (dynamic partition
    overwrite), so a load that fails leaves the old months whole. A month
    without rows becomes empty. Rows of other months are an error."""
    months = list(dict.fromkeys(months))
    stray = df.where(F.col(month_col).isNull() | ~F.col(month_col).isin(months)).limit(1).count()
    if stray:
        raise ValueError(f"rows outside the months {months}")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month_col).parquet(path)
    written = {r[0] for r in df.select(month_col).distinct().collect()}  # at most the months named
    for m in months:
        if m not in written:
            delete_path(df.sparkSession, f"{path.rstrip('/')}/{month_col}={m}")


def time_state(rides: DataFrame, month_col: str = MONTH) -> DataFrame:
    """Counts of rides by month, calendar keys, segment and duration, before
    the outlier cut."""
    return rides.groupBy(month_col, *TIME_STATE).agg(F.count(F.lit(1)).alias("n"))


def merged_stats(state: DataFrame) -> DataFrame:
    """Mean and population SD of the minutes (A3) from merged states, one row:
    exact sums, divided once."""
    d, n = F.col("duration").cast("decimal(38,0)"), F.col("n").cast("decimal(38,0)")
    some = state.where("duration IS NOT NULL")
    sums = some.agg(F.sum("n").alias("n"), F.sum(d * n).alias("s"), F.sum(d * d * n).alias("q"))
    count, total = F.col("n").cast("double"), F.col("s").cast("double")
    spread = (F.col("n").cast("decimal(38,0)") * F.col("q") - F.col("s") * F.col("s")).cast("double")
    return sums.select((total / count).alias("mean"), (F.sqrt(spread) / count).alias("sd"))


def merged_time_rollup(state: DataFrame, z: ZScoreParams = ZScoreParams()) -> DataFrame:
    """The time rollup (A4) after the z-score cut from merged states of any
    months: equal to ``time_rollup`` over all their rides."""
    stats = merged_stats(state).select(F.struct("mean", "sd").alias("v")).scalar()
    far = F.abs(F.try_divide(F.col("duration").cast("double") - stats["mean"], stats["sd"]))
    kept = state.where(far < z.k) if z.strict else state.where(~F.coalesce(far > z.k, F.lit(False)))
    out = kept.withColumn("type", segment_label("member", "rideable_type"))
    out = out.groupBy("year", "month", "weekday", "hour", "type", "member", "rideable_type").agg(
        F.sum("n").alias("n_trips"), F.sum(F.col("duration").cast("long") * F.col("n")).alias("duration")
    )
    keys = ["type", "year", "month", "weekday", "hour", "member", "rideable_type"]
    return out.select(*keys, "n_trips", "duration", (F.col("duration") / F.col("n_trips")).alias("avg_duration"))


def month_sketches(rides: DataFrame, by: Sequence[str], distinct: str, value: str, month_col: str = MONTH) -> DataFrame:
    """Per month and group: an HLL sketch of the distinct values of
    ``distinct`` (A21) and a KLL sketch of the integers ``value`` (A23)."""
    return rides.groupBy(month_col, *by).agg(
        F.hll_sketch_agg(F.col(distinct), F.lit(HLL_LG)).alias("distinct_sketch"),
        F.kll_sketch_agg_bigint(F.col(value).cast("long"), F.lit(KLL_K)).alias("value_sketch"),
        F.count(F.lit(1)).alias("n"),
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Estimates of any months' sketches together: ``n_distinct`` (within
    HLL_BOUND of the exact count in 95 of 100 cases), and the quantiles
    ``q25``, ... (of a rank within KLL_BOUND of the asked one in 99 of 100)."""
    merged = sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
        F.kll_merge_agg_bigint("value_sketch").alias("__values"),
        F.sum("n").alias("n"),
    )
    asked = {f"q{int(100 * q)}": F.kll_sketch_get_quantile_bigint("__values", F.lit(float(q))) for q in quantiles}
    return merged.withColumns(asked).drop("__values")
