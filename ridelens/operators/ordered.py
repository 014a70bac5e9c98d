"""Positions, running totals and lags over a whole frame in order
(W2, W3, O1, O3, O4), without moving the frame into one task.

A window without partitions sorts its whole input in one task. Here the rows are
range-partitioned by the order (a sampled range exchange, so each task gets about
as many rows), each range is numbered and summed on its own, and the totals of
the ranges before it are added. Only one row per range reaches the driver.

Rows that are equal in the order are dealt over several ranges by a hash of the
row and a row tag, so that a value holding a third of all rows does not make one
range of them all; among themselves they come in the order of that hash, then of
the tag, which is arbitrary but kept with the written ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelens.sources.files import checkpoint_table

_RANGE, _TIE, _TAG = "__range", "__tie", "__tag"


def _keys(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _ranges(df: DataFrame, order: Sequence[Column | str], ranges: int | None) -> tuple[DataFrame, list[Column]]:
    """``df`` in written ranges of the order, the range's number in ``_RANGE``."""
    tagged = df.withColumn(_TIE, F.xxhash64(*[F.col(c) for c in df.columns])).withColumn(_TAG, F.monotonically_increasing_id())
    keys = [*_keys(order), F.col(_TIE).asc(), F.col(_TAG).asc()]
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tagged.repartitionByRange(n, *keys).withColumn(_RANGE, F.spark_partition_id())
    return checkpoint_table(dealt, "ordered_ranges"), keys


def ordered(
    df: DataFrame,
    order: Sequence[Column | str],
    position: str | None = "position",
    totals: Mapping[str, str] | None = None,
    lags: Mapping[str, str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``df`` with its row's ``position`` (from 1) in ``order``; with
    ``totals`` = {new column: column}, the running total of that column up to
    and including the row (NULL counts as nothing); with ``lags``, the running
    total before the row, 0 for the first (W3). The rows come in no order;
    ``write_ordered`` writes them in it."""
    spark = df.sparkSession
    totals, lags = dict(totals or {}), dict(lags or {})
    summed = list(dict.fromkeys([*totals.values(), *lags.values()]))
    written, keys = _ranges(df, order, ranges)
    parts = written.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(f"t{i}") for i, c in enumerate(summed)))
    # one row per range
    before, offsets = [0, *(0 for _ in summed)], []
    for r in sorted(parts.collect(), key=lambda r: r[_RANGE]):
        offsets.append((r[_RANGE], *before))
        before = [b + (x or 0) for b, x in zip(before, r[1:])]
    types = [parts.schema[f"t{i}"].dataType.simpleString() for i in range(len(summed))]
    names = [f"{_RANGE} int", "__n long", *(f"__t{i} {t}" for i, t in enumerate(types))]
    if not offsets:
        offsets = [(0, *before)]
    kinds = [int, int, *(float if t == "double" else Decimal if t.startswith("decimal") else int for t in types)]
    starts = spark.createDataFrame([tuple(k(x) for k, x in zip(kinds, o)) for o in offsets], ", ".join(names))
    own = Window.partitionBy(_RANGE).orderBy(*keys)
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = own.rowsBetween(Window.unboundedPreceding, -1)
    out = written.join(F.broadcast(starts), _RANGE)
    columns = [F.col(c) for c in df.columns]
    if position:
        columns.append((F.col("__n") + F.row_number().over(own)).alias(position))
    for new, frame in ((totals, upto), (lags, above)):
        for name, c in new.items():
            columns.append((F.col(f"__t{summed.index(c)}") + F.coalesce(F.sum(c).over(frame), F.lit(0))).alias(name))
    return out.select(*columns)


def write_ordered(df: DataFrame, path: str, order: Sequence[Column | str], position: str = "position", ranges: int | None = None) -> DataFrame:
    """Write ``df`` with its positions as Parquet files whose names and rows
    follow the order, and return the written table. Reading the files by name
    gives the rows in order; a range of positions is found by the statistics of
    the files."""
    placed = ordered(df, order, position, ranges=ranges)
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed.repartitionByRange(n, position).sortWithinPartitions(position).write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)

