"""Sinks: snapshots, appends, partitioned / quoted / plain delimited text."""

from dimsmith.sinks.files import (  # noqa: F401
    append,
    latest_snapshot,
    latest_snapshot_path,
    write_partitioned_csv,
    write_quoted_csv,
    write_snapshot,
    write_text_table,
)
