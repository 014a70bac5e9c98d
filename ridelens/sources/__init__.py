"""Readers and writers."""

from ridelens.sources.files import (  # noqa: F401
    checkpoint_table,
    describe_columns,
    preview,
    read_areas,
    read_stations,
    read_trip_text,
    read_trips,
    read_trips_checked,
    reject_counts,
    split_rejected,
    type_trip_text,
    union_months,
    write_report,
    write_table,
)
from ridelens.sources.jdbc import jdbc_options, read_jdbc  # noqa: F401
