"""Z-score outlier cuts.

The statistics are one global aggregate (partial per task, one tiny final
step) read as a scalar subquery: computed once, then every task compares its
rows with the two numbers, so the rows are never moved and nothing is joined.
A global window would pull every row into one partition instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.functions.scalar import exact_ratio
from ridelens.operators._plan import scalar_of
from ridelens.operators.predicates import delete_where


def zscore_stats(df: DataFrame, col: str, sd: str = "pop", mean_scale: int | None = None) -> DataFrame:
    """Mean and SD of ``col`` in one row (A3). ``sd="pop"`` is SQL STDDEV,
    ``sd="samp"`` is R's sd (T3). ``mean_scale`` rounds the mean as an exact
    decimal average does (T13)."""
    sd_fn = {"pop": F.stddev_pop, "samp": F.stddev_samp}[sd]
    mean = F.avg(F.col(col).cast("double"))
    if mean_scale is not None:
        integral = dict(df.dtypes)[col] in ("tinyint", "smallint", "int", "bigint")
        # AVG of an integer column is an exact decimal rounded once; the sum
        # and count are exact, so the rounding is done on them.
        mean = (
            exact_ratio(F.sum(F.col(col).cast("long")), F.count(col), mean_scale)
            if integral
            else F.round(mean, mean_scale)
        )
    return df.agg(mean.alias("__mean"), sd_fn(F.col(col).cast("double")).alias("__sd"))


def zscore(df: DataFrame, col: str, sd: str = "pop", out: str = "z", mean_scale: int | None = None) -> DataFrame:
    """Add the z-score of ``col``; SD 0 or NULL gives a NULL z."""
    stats = scalar_of(zscore_stats(df, col, sd, mean_scale).select(F.struct("__mean", "__sd")))
    z = F.try_divide(F.col(col).cast("double") - stats.getField("__mean"), stats.getField("__sd"))
    return df.withColumn(out, z)


def drop_zscore(
    df: DataFrame,
    col: str,
    k: float = 3.0,
    sd: str = "pop",
    strict: bool = False,
    mean_scale: int | None = None,
) -> DataFrame:
    """Remove outliers of ``col``.

    SQL form (default): delete abs(z) > k; abs(z) = k and NULL z are kept.
    R form (``sd="samp", strict=True``): keep abs(z) < k; NULL/NaN dropped.
    Deleting the rows whose value is IN the outlier values (J4) is the same
    row filter, because z depends on the value only.
    """
    z = "__z"
    scored = zscore(df, col, sd=sd, out=z, mean_scale=mean_scale)
    if strict:
        kept = scored.filter(F.abs(F.col(z)) < k)
    else:
        kept = delete_where(scored, F.abs(F.col(z)) > k)
    return kept.drop(z)
