"""Registered queries: one Spark builder per operator + equivalent DuckDB SQL.

Each builder takes (spark, sf_dir) and returns a DataFrame over the given
parquet tables; ``ORACLE[name]`` is the same result written as plain SQL.
"""

from __future__ import annotations

from dimsmith.catalog.registry import ORACLE, QUERIES  # noqa: F401
from dimsmith.catalog import (  # noqa: F401  (import for registration)
    cdc_queries,
    dim_queries,
    report_queries,
    inventory_queries,
    quality_queries,
    generate_queries,
    stream_queries,
    io_queries,
    star_layout,
    lifecycle_queries,
)

__all__ = ["QUERIES", "ORACLE"]
