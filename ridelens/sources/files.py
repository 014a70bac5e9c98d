"""File sources and sinks: monthly trip CSVs, the station list, GeoJSON
areas, parquet tables and checkpoints (S1-S5, S7-S15)."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelens.functions.scalar import blank_to_null_text
from ridelens.schema import STATIONS_RAW, TEXT_COLUMNS, TRIP_FILE_REGEX, TRIP_FILE_SUFFIX, TRIPS_RAW
from ridelens.session import scratch_path

# Every trip column is read as text and typed afterwards, so that blank, quoted
# blank and 'NA' fields follow the reference's loader (T2) and a malformed value
# is either NULL (permissive) or an error (strict).
TRIPS_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in TRIPS_RAW.fields])


def type_trip_text(df: DataFrame, strict: bool = False) -> DataFrame:
    """Type the text columns of a trip file."""
    cols = []
    for f in TRIPS_RAW.fields:
        c = F.col(f.name)
        if f.name in TEXT_COLUMNS:
            c = blank_to_null_text(c)
        else:
            # Blank and NA are missing values; only other text can be malformed.
            c = F.when((c == "NA") | (F.trim(c) == ""), F.lit(None).cast("string")).otherwise(c)
            c = c.cast(f.dataType) if strict else c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    extra = [c for c in df.columns if c not in TRIPS_TEXT.fieldNames()]
    return df.select(*cols, *extra)


#: The text of a line that does not have the columns of a trip file.
_CORRUPT = "__corrupt"
# A line is judged by all its fields, whichever columns a query reads.
_CHECKED = {"columnNameOfCorruptRecord": _CORRUPT, "columnPruning": "false"}


def split_rejected(text_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed trips and rejected rows of trip text.

    A row is rejected when its line has too few or too many fields, or when a
    value that is neither blank nor 'NA' is no value of its column's type: such
    a value would turn NULL and the main clean would drop the row unseen. The
    rejected rows have ``reason`` (the columns at fault, comma-joined, or
    'line'), ``value`` (the first faulty text, or the line), and the other
    columns as text. Every row is in exactly one of the two frames."""
    faults = []
    for f in TRIPS_RAW.fields:
        if f.name not in TEXT_COLUMNS:
            c = F.col(f.name)
            present = c.isNotNull() & (F.trim(c) != "") & (c != "NA")
            faults.append(F.when(present & c.try_cast(f.dataType).isNull(), F.struct(F.lit(f.name).alias("column"), c.alias("value"))))
    found = F.filter(F.array(*faults), lambda x: x.isNotNull())
    if _CORRUPT in text_df.columns:
        line = F.struct(F.lit("line").alias("column"), F.col(_CORRUPT).alias("value"))
        found = F.when(F.col(_CORRUPT).isNotNull(), F.array(line)).otherwise(found)
    marked = text_df.withColumn("__faults", found)
    good = type_trip_text(marked.where(F.size("__faults") == 0).drop("__faults", _CORRUPT))
    bad = marked.where(F.size("__faults") > 0).select(
        F.array_join(F.transform("__faults", lambda x: x["column"]), ",").alias("reason"),
        F.get("__faults", F.lit(0))["value"].alias("value"),
        *[c for c in text_df.columns if c != _CORRUPT],
    )
    return good, bad


def read_trips_checked(spark: SparkSession, path: str, quarantine: str | None = None, **where) -> tuple[DataFrame, DataFrame]:
    """``read_trips`` with a channel for malformed rows: the typed trips, and
    the rejected rows with reason, value, file and month. ``quarantine`` names a
    folder that the rejected rows are appended to, by month and reason."""
    text = _trip_text(spark, path, T.StructType([*TRIPS_TEXT.fields, T.StructField(_CORRUPT, T.StringType())]), **_CHECKED, **where)
    good, bad = split_rejected(text)
    if quarantine is not None:
        bad.write.mode("append").partitionBy("source_month", "reason").parquet(quarantine)
    return good, bad


def read_trip_text(spark: SparkSession, path: str) -> DataFrame:
    """Trip text without headers from a folder per ``source_month``, with the
    malformed lines, for ``split_rejected``."""
    schema = T.StructType([*TRIPS_TEXT.fields, T.StructField(_CORRUPT, T.StringType()), T.StructField("source_month", T.StringType())])
    return spark.read.schema(schema).options(**_CHECKED).csv(path)


def reject_counts(good: DataFrame, bad: DataFrame, by: str = "source_month") -> DataFrame:
    """Accepted and rejected rows by month and reason (NULL: accepted)."""
    rows = good.select(by, F.lit(None).cast("string").alias("reason")).unionByName(bad.select(by, "reason"))
    return rows.groupBy(by, "reason").agg(F.count(F.lit(1)).alias("n_rows"))


# The suffix as a glob: the regular expression's "." matches any character.
_SUFFIX_GLOB = TRIP_FILE_SUFFIX.replace(".", "?")


def _glob_of(pattern: str) -> str:
    """A file-name glob admitting exactly the names the unanchored regular
    expression admits (``?`` stands for the regex's ``.``), so files are
    pruned when the folder is listed; other patterns fall back to ``*``."""
    if pattern == TRIP_FILE_REGEX:
        return "*202[4-5][0-1][0-9]" + _SUFFIX_GLOB + "*"
    return "*"


def month_names(first: str, last: str) -> list[str]:
    """YYYYMM names from ``first`` to ``last`` inclusive."""
    y, m = int(first[:4]), int(first[4:6])
    out = []
    while (y, m) <= (int(last[:4]), int(last[4:6])):
        out.append(f"{y:04d}{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def read_trips(
    spark: SparkSession,
    path: str,
    pattern: str = TRIP_FILE_REGEX,
    months: tuple[str, str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """All monthly trip files under ``path`` as one scan.

    ``pattern`` is the reference's unanchored file-name regex; ``source_month``
    is the file name with the suffix removed (the reference's table name
    without ``t_``); ``months=(first, last)`` keeps the named months of that
    range, as the reference's union of named monthly tables does. The choice
    of files is also given as a glob, so unwanted files are never opened;
    the row filters keep it exact. One multi-file scan replaces the union of
    per-month tables; the files are split into tasks by size.
    """
    text = _trip_text(spark, path, TRIPS_TEXT, pattern, months, mode="FAILFAST" if strict else "PERMISSIVE")
    return type_trip_text(text, strict=strict)


def _trip_text(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str = TRIP_FILE_REGEX,
    months: tuple[str, str] | None = None,
    **options,
) -> DataFrame:
    """The trip files as text, with ``source_month``."""
    names = month_names(*months) if months is not None else None
    glob = _glob_of(pattern)
    if names is not None and pattern == TRIP_FILE_REGEX:
        glob = "{" + ",".join(names) + "}" + _SUFFIX_GLOB
    reader = spark.read.schema(schema).option("header", True).option("pathGlobFilter", glob).options(**options)
    return select_trip_files(reader.csv(path), pattern, names)


def select_trip_files(raw: DataFrame, pattern: str = TRIP_FILE_REGEX, names: Sequence[str] | None = None) -> DataFrame:
    """Keep rows of files whose name matches ``pattern`` (and whose month is
    in ``names``) and add ``source_month``: the file name with every match of
    the suffix expression removed, as the reference names its tables."""
    fname = F.col("_metadata.file_name")
    raw = raw.withColumn("__file", fname).filter(F.col("__file").rlike(pattern))
    raw = raw.withColumn("source_month", F.regexp_replace(F.col("__file"), TRIP_FILE_SUFFIX, "")).drop("__file")
    if names is not None:
        raw = raw.filter(F.col("source_month").isin(list(names)))
    return raw


def union_months(frames: Mapping[str, DataFrame] | Sequence[DataFrame], by_position: bool = False) -> DataFrame:
    """UNION ALL of monthly frames given separately (U1); duplicates kept.

    A mapping ``{"202401": df, ...}`` adds ``source_month`` from its keys.
    ``by_position=True`` unions by column position, as ``SELECT *`` unions
    do; the default matches columns by name. A single multi-file scan
    (``read_trips``) is the better plan when the months are files.
    """
    if isinstance(frames, Mapping):
        items = [f.withColumn("source_month", F.lit(k)) for k, f in frames.items()]
    else:
        items = list(frames)
    out = items[0]
    for f in items[1:]:
        out = out.union(f) if by_position else out.unionByName(f)
    return out


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """The published station list with its eight headers."""
    return spark.read.schema(STATIONS_RAW).option("header", True).csv(path)


_RING = "array<array<double>>"


def read_areas(spark: SparkSession, path: str, name_property: str = "community") -> DataFrame:
    """GeoJSON FeatureCollection of Polygon / MultiPolygon areas.

    ``coordinates`` is read as raw JSON text and parsed by geometry type; the
    result has ``area_id`` (feature order), the name property and ``polygon``
    as MultiPolygon coordinates. A local or shared path, never a URL.
    """
    schema = T.StructType(
        [
            T.StructField(
                "features",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
                            T.StructField(
                                "geometry",
                                T.StructType(
                                    [
                                        T.StructField("type", T.StringType()),
                                        T.StructField("coordinates", T.StringType()),
                                    ]
                                ),
                            ),
                        ]
                    )
                ),
            )
        ]
    )
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    feats = doc.select(F.posexplode("features").alias("area_id", "f"))
    gtype = F.col("f.geometry.type")
    coords = F.col("f.geometry.coordinates")
    polygon = F.when(gtype == "Polygon", F.array(F.from_json(coords, f"array<{_RING}>"))).when(
        gtype == "MultiPolygon", F.from_json(coords, f"array<array<{_RING}>>")
    )
    return feats.select(
        F.col("area_id").cast("long").alias("area_id"),
        F.col("f.properties").getItem(name_property).alias(name_property),
        polygon.alias("polygon"),
    )


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """CREATE TABLE AS / overwrite load as a parquet write."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def checkpoint_table(df: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the session's shared checkpoint folder
    and read it back: a reliable copy that cuts the lineage (S10).

    Every call writes a fresh folder (without ``base`` it is deleted by
    ``session.clear_scratch`` or when the process ends), so a frame read from an earlier call is
    never overwritten by a later one. The copy survives the loss of any
    executor, unlike a local checkpoint, and later readers get column pruning
    and filter pushdown on it.
    """
    spark = df.sparkSession
    path = posixpath.join(base, "tables", f"{name}-{uuid.uuid4().hex}") if base else scratch_path(spark, "tables", name)
    schema = df.schema
    df.write.mode("errorifexists").parquet(path)
    # The schema is known: reading it back needs no footer-inference job.
    return spark.read.schema(schema).parquet(path)


def describe_columns(df: DataFrame) -> DataFrame:
    """Column name and type of a table (S14); schema metadata only."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def preview(df: DataFrame, n: int = 6, order_by: Sequence[str] | str | None = None) -> DataFrame:
    """First ``n`` rows in a stated order (S15, O6): a top-n, not a full sort."""
    if order_by is None:
        order_by = df.columns
    if isinstance(order_by, str):
        order_by = [order_by]
    return df.orderBy(*order_by).limit(n)


def write_report(frames: Mapping[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write the frame behind each chart as parquet."""
    paths = {}
    for name, frame in frames.items():
        path = posixpath.join(out_dir, name)
        frame.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths
