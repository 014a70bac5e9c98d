"""Incremental loading of monthly trip files with Structured Streaming."""

from ridelens.streaming.ingest import ingest_trip_files, trip_file_stream  # noqa: F401
