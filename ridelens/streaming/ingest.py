"""The reference loads each monthly file into its own table and then merges
them (S1-S5, U1). As a stream, new monthly files in a folder are picked up
once each and appended to one trip table partitioned by ``source_month``; the
checkpoint records which files were loaded, so a restarted or failed job
neither skips nor repeats a file.

Only stateless steps run on the stream (typing, the blank/NA rule, the
optional row-level clean). Duplicate removal removes *every* copy of a key,
which needs the whole table, so it stays a batch step over the loaded table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ridelens.operators.clean import clean_trips
from ridelens.operators.derive import type_timestamps
from ridelens.schema import TRIP_FILE_REGEX
from ridelens.sources.files import TRIPS_TEXT, _glob_of, select_trip_files, type_trip_text


def trip_file_stream(
    spark: SparkSession,
    src_dir: str,
    pattern: str = TRIP_FILE_REGEX,
    files_per_trigger: int = 1,
    clean: bool = False,
) -> DataFrame:
    """A streaming DataFrame over the monthly trip files of ``src_dir``."""
    raw = (
        spark.readStream.schema(TRIPS_TEXT)
        .option("header", True)
        .option("pathGlobFilter", _glob_of(pattern))
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(src_dir)
    )
    typed = type_timestamps(type_trip_text(select_trip_files(raw, pattern)))
    return clean_trips(typed) if clean else typed


def ingest_trip_files(
    spark: SparkSession,
    src_dir: str,
    out_dir: str,
    checkpoint_location: str,
    pattern: str = TRIP_FILE_REGEX,
    clean: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Append new monthly files to the parquet trip table at ``out_dir``.

    ``checkpoint_location`` is a folder of this source and output alone: it
    records the files that were loaded, so two ingests must not share one.
    ``available_now=True`` loads every file present and stops (a scheduled
    batch job with exactly-once file tracking); ``False`` keeps polling.
    """
    stream = trip_file_stream(spark, src_dir, pattern, clean=clean)
    writer = (
        stream.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_location)
        .partitionBy("source_month")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
