"""Structured Streaming: file ingest, stream joins, incremental apply-changes."""
