"""Batch and incremental sources: delimited files, schema drift, calendar."""
