"""dimsmith — Spark-native lakehouse and dimensional-modelling toolkit.

Layers:
  sources/    file ingestion (batch + incremental), calendar generator
  sinks/      snapshot / partitioned / quoted writers
  functions/  column-level helpers (date keys, seeded draws, json paths)
  operators/  change-data apply, keys, SCD merge, temporal joins, reports
  streaming/  Structured Streaming ingest and incremental apply-changes
  plans/      declarative table graph, YAML specs, expectations, event log
  catalog/    the registered queries (Spark builders + oracle SQL)
"""

from dimsmith.session import get_spark, work_dir  # noqa: F401
from dimsmith.operators.cdc import ChangeSpec, apply_changes  # noqa: F401
from dimsmith.operators.keys import assign_durable_keys, assign_surrogate_keys  # noqa: F401
from dimsmith.operators.latest import latest_by  # noqa: F401
from dimsmith.operators.ordered import (fill_within_key, global_rank,  # noqa: F401
                                        next_within_key, version_numbers)
from dimsmith.operators.reports import rollup_with_totals  # noqa: F401
from dimsmith.operators.scd import (DimSpec, backfill_from, current_view,  # noqa: F401
                                    duplicate_keys, null_counts, scd2_merge)
from dimsmith.operators.temporal import as_of, temporal_join  # noqa: F401
from dimsmith.plans.graph import TableGraph  # noqa: F401
from dimsmith.plans.quality import Expectation, apply_expectations, quality_report  # noqa: F401
from dimsmith.plans.spec import build_graph, load_spec  # noqa: F401
from dimsmith.streaming.apply_changes import apply_changes_stream, read_target  # noqa: F401

__all__ = [
    "get_spark", "work_dir", "ChangeSpec", "apply_changes", "apply_changes_stream",
    "read_target", "assign_durable_keys", "assign_surrogate_keys", "latest_by",
    "fill_within_key", "global_rank", "next_within_key", "version_numbers",
    "rollup_with_totals", "DimSpec", "backfill_from", "current_view", "duplicate_keys",
    "null_counts", "scd2_merge", "as_of", "temporal_join", "TableGraph", "Expectation",
    "apply_expectations", "quality_report", "build_graph", "load_spec",
]
