"""Pipeline event log and its reports.

Rows: ``timestamp``, ``event_type`` ('create_update' once per run,
'flow_progress' per table per run), ``origin`` struct<update_id, flow_name>,
``details`` JSON string with ``flow_progress.metrics.num_output_rows`` and
``flow_progress.data_quality.{dropped_records, expectations[]}``.

The runner in ``plans.graph`` appends these rows (one per table per run, so
a handful of rows however big the data). The readers below are plain Spark
SQL over the log table: latest run, quality per rule, rows per table.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimsmith.functions.variant import at, elements, variant_column

EXPECTATIONS_DDL = ("array<struct<name: string, dataset: string, "
                    "passed_records: bigint, failed_records: bigint>>")

LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("origin", T.StructType([
        T.StructField("update_id", T.StringType()),
        T.StructField("flow_name", T.StringType())])),
    T.StructField("details", T.StringType()),
])


def log_rows(spark: SparkSession, update_id: str, started: dt.datetime,
             flows: dict[str, dict]) -> DataFrame:
    """Event-log rows of one run: create_update + one flow_progress per flow."""
    rows = [(started, "create_update", (update_id, None), json.dumps({"create_update": {}}))]
    for flow, progress in flows.items():
        rows.append((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), "flow_progress",
                     (update_id, flow), json.dumps({"flow_progress": progress})))
    return spark.createDataFrame(rows, LOG_SCHEMA)


def latest_update_id(log: DataFrame) -> DataFrame:
    """L2: update id of the newest create_update event (max_by, no sort)."""
    return (log.where(F.col("event_type") == "create_update")
            .agg(F.max_by(F.col("origin.update_id"), F.col("timestamp")).alias("update_id")))


def _last_run(log: DataFrame) -> DataFrame:
    last = latest_update_id(log).scalar()
    return log.where((F.col("event_type") == "flow_progress") & (F.col("origin.update_id") == last))


def quality_by_rule(log: DataFrame) -> DataFrame:
    """L3: passed / failed records per (dataset, expectation) of the last run."""
    exp = F.from_json(F.get_json_object("details", "$.flow_progress.data_quality.expectations"),
                      EXPECTATIONS_DDL)
    return (_last_run(log).select(F.explode(exp).alias("e"))
            .groupBy(F.col("e.dataset").alias("dataset"), F.col("e.name").alias("expectation"))
            .agg(F.sum("e.passed_records").alias("passing_records"),
                 F.sum("e.failed_records").alias("failing_records")))


def rows_by_table(log: DataFrame) -> DataFrame:
    """L4: output and dropped rows per table of the last run (no metrics -> removed)."""
    metrics = F.from_json(F.get_json_object("details", "$.flow_progress.metrics"),
                          "struct<num_output_rows: bigint>")
    dq = F.from_json(F.get_json_object("details", "$.flow_progress.data_quality"),
                     "struct<dropped_records: bigint>")
    return (_last_run(log)
            .select(F.col("origin.flow_name").alias("table_name"),
                    metrics.num_output_rows.alias("num_output_rows"),
                    dq.dropped_records.alias("dropped_records"))
            .where(F.col("num_output_rows").isNotNull())
            .orderBy("table_name"))


def trace_key(tables: dict[str, DataFrame], where: str, order_by: str | None = None) -> DataFrame:
    """One key followed through several tables (bronze, history, SCD 1,
    SCD 2): rows matching ``where`` from each table, unioned by name with a
    ``table`` column (missing columns NULL), sorted by table and ``order_by``."""
    out = None
    for name, df in tables.items():
        part = df.where(where).withColumn("table", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tables given")
    sort = ["table"] + ([order_by] if order_by and order_by in out.columns else [])
    return out.orderBy(*sort)


def parsed(log: DataFrame) -> DataFrame:
    """The log with ``details`` as a VARIANT, to be stored or read by path."""
    return variant_column(log, "details")


def flow_metrics(log: DataFrame) -> DataFrame:
    """Every run's flows of a parsed log: run (1, 2, ...), table_name, rows written, dropped and late, number of rules."""
    runs = (log.where(F.col("event_type") == "create_update")           # a row a run
            .select(F.col("origin.update_id").alias("update_id"), F.row_number().over(Window.orderBy("timestamp")).alias("run")))
    flows = log.where(F.col("event_type") == "flow_progress").withColumn("update_id", F.col("origin.update_id"))
    return flows.join(runs, "update_id").select(
        "run", F.col("origin.flow_name").alias("table_name"),
        at("details", "flow_progress.metrics.num_output_rows", "bigint").alias("num_output_rows"),
        at("details", "flow_progress.data_quality.dropped_records", "bigint").alias("dropped_records"),
        at("details", "flow_progress.metrics.num_late_rows", "bigint").alias("late_rows"),
        F.size(elements("details", "flow_progress.data_quality.expectations")).cast("bigint").alias("rules"))
