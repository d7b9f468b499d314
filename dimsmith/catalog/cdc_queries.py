"""Change-data apply over the ``events`` feed (key user_id, sequence ts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimsmith.catalog.registry import query, table
from dimsmith.operators.cdc import ChangeSpec, apply_changes

# Fixed parameters of the change-feed queries.
EVENT_KEYS = ["user_id"]
EVENT_SEQ = "ts"
EVENT_EXCEPT = ["props"]
DELETE_WHEN = "event_type = 'error'"
NULL_WHEN = "event_type = 'view'"
TRUNCATE_WHEN_SPARK = "event_type = 'signup' AND ts < TIMESTAMP_NTZ'2024-01-10 00:00:00'"
TRUNCATE_WHEN_SQL = "event_type = 'signup' AND ts < TIMESTAMP '2024-01-10 00:00:00'"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query("history_no_scd", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def history_no_scd(spark, sf_dir):
    """Append-all history — a stream appends every landed change row, duplicates included."""
    from dimsmith.catalog.stream_queries import BATCHES, land
    from dimsmith.session import work_dir
    from dimsmith.streaming.ingest import ingest_files, run_to_end
    wd, events = work_dir(spark, "history"), _events(spark, sf_dir)
    for part in range(BATCHES):
        land(events, f"{wd}/landed", by=["event_id"], part=part)
        src = spark.readStream.schema(events.schema).parquet(f"{wd}/landed")
        run_to_end(ingest_files(src, f"{wd}/history", f"{wd}/_checkpoint"))
    return spark.read.parquet(f"{wd}/history")


@query("scd1_events", """
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)
WHERE rn = 1
""")
def scd1_events(spark, sf_dir):
    """SCD 1 — latest change per key by sequence; late older rows ignored."""
    spec = ChangeSpec(keys=EVENT_KEYS, sequence_by=EVENT_SEQ, stored_as_scd_type=1,
                      except_columns=EVENT_EXCEPT)
    return apply_changes(_events(spark, sf_dir), spec)


@query("scd2_events", """
SELECT user_id, event_id, event_type, value, ts AS start_at,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at
FROM events
""")
def scd2_events(spark, sf_dir):
    """S3: SCD 2 — every change a version, end = next change, NULL = current."""
    spec = ChangeSpec(keys=EVENT_KEYS, sequence_by=EVENT_SEQ, stored_as_scd_type=2,
                      except_columns=EVENT_EXCEPT)
    return apply_changes(_events(spark, sf_dir), spec)


@query("scd2_events_deletes", """
SELECT user_id, event_id, event_type, value, start_at, end_at FROM (
  SELECT *, ts AS start_at, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at
  FROM events)
WHERE NOT (event_type = 'error')
""")
def scd2_events_deletes(spark, sf_dir):
    """APPLY AS DELETE — a delete closes the version before it."""
    spec = ChangeSpec(keys=EVENT_KEYS, sequence_by=EVENT_SEQ, stored_as_scd_type=2,
                      except_columns=EVENT_EXCEPT, apply_as_deletes=DELETE_WHEN)
    return apply_changes(_events(spark, sf_dir), spec)


@query("scd1_deletes", """
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)
WHERE rn = 1 AND NOT (event_type = 'error')
""")
def scd1_deletes(spark, sf_dir):
    """APPLY AS DELETE on SCD 1 — a key whose latest change is a delete is gone."""
    spec = ChangeSpec(keys=EVENT_KEYS, sequence_by=EVENT_SEQ, stored_as_scd_type=1,
                      except_columns=EVENT_EXCEPT, apply_as_deletes=DELETE_WHEN)
    return apply_changes(_events(spark, sf_dir), spec)


@query("scd1_ignore_nulls", """
WITH src AS (
  SELECT user_id, ts, event_id, event_type,
         CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value
  FROM events),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM src)
  WHERE rn = 1),
nn AS (
  SELECT user_id, value FROM (
    SELECT user_id, value,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
    FROM src WHERE value IS NOT NULL)
  WHERE rn = 1)
SELECT l.user_id, l.ts, l.event_id, l.event_type, nn.value
FROM latest l LEFT JOIN nn ON nn.user_id = l.user_id
""")
def scd1_ignore_nulls(spark, sf_dir):
    """IGNORE NULL UPDATES — a NULL keeps the previous value (per column)."""
    src = _events(spark, sf_dir).withColumn(
        "value", F.when(F.expr(NULL_WHEN), F.lit(None).cast("double")).otherwise(F.col("value")))
    spec = ChangeSpec(keys=EVENT_KEYS, sequence_by=EVENT_SEQ, stored_as_scd_type=1,
                      except_columns=EVENT_EXCEPT, ignore_null_updates=True)
    return apply_changes(src, spec)


@query("scd2_truncate", f"""
WITH t AS (SELECT max(ts) AS t FROM events WHERE {TRUNCATE_WHEN_SQL}),
src AS (SELECT e.* FROM events e, t WHERE t.t IS NULL OR e.ts > t.t)
SELECT user_id, event_id, event_type, value, ts AS start_at,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at
FROM src
""")
def scd2_truncate(spark, sf_dir):
    """APPLY AS TRUNCATE — only changes after the latest truncate survive."""
    spec = ChangeSpec(keys=EVENT_KEYS, sequence_by=EVENT_SEQ, stored_as_scd_type=2,
                      except_columns=EVENT_EXCEPT, apply_as_truncates=TRUNCATE_WHEN_SPARK)
    return apply_changes(_events(spark, sf_dir), spec)


@query("scd1_where_columns", """
SELECT user_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
  FROM events WHERE event_type <> 'signup')
WHERE rn = 1
""")
def scd1_where_columns(spark, sf_dir):
    """Source WHERE plus an explicit column list."""
    spec = ChangeSpec(keys=EVENT_KEYS, sequence_by=EVENT_SEQ, stored_as_scd_type=1,
                      columns=["user_id", "ts", "event_type", "value"],
                      where="event_type <> 'signup'")
    return apply_changes(_events(spark, sf_dir), spec)


@query("scd2_ignore_nulls", """
WITH src AS (
  SELECT user_id, ts, event_id, event_type,
         CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value
  FROM events)
SELECT user_id, event_id, event_type,
       last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value,
       ts AS start_at, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at
FROM src
""")
def scd2_ignore_nulls(spark, sf_dir):
    """IGNORE NULL UPDATES on SCD 2 — a NULL carries the previous version's value."""
    src = _events(spark, sf_dir).withColumn(
        "value", F.when(F.expr(NULL_WHEN), F.lit(None).cast("double")).otherwise(F.col("value")))
    spec = ChangeSpec(keys=EVENT_KEYS, sequence_by=EVENT_SEQ, stored_as_scd_type=2,
                      except_columns=EVENT_EXCEPT, ignore_null_updates=True)
    return apply_changes(src, spec)


@query("scd2_ignore_nulls_deletes", """
WITH src AS (
  SELECT user_id, ts, event_id, event_type,
         CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value
  FROM events),
seg AS (
  SELECT *, max(CASE WHEN event_type = 'error' THEN ts END)
              OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS last_del
  FROM src),
filled AS (
  SELECT *, last_value(CASE WHEN value IS NOT NULL AND (last_del IS NULL OR ts > last_del)
                            THEN value END IGNORE NULLS)
              OVER (PARTITION BY user_id, last_del ORDER BY ts
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled_value,
            lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at
  FROM seg)
SELECT user_id, event_id, event_type, filled_value AS value, ts AS start_at, end_at
FROM filled WHERE NOT (event_type = 'error')
""")
def scd2_ignore_nulls_deletes(spark, sf_dir):
    """IGNORE NULL UPDATES with APPLY AS DELETE on SCD 2 — values never
    carry across a delete."""
    src = _events(spark, sf_dir).withColumn(
        "value", F.when(F.expr(NULL_WHEN), F.lit(None).cast("double")).otherwise(F.col("value")))
    spec = ChangeSpec(keys=EVENT_KEYS, sequence_by=EVENT_SEQ, stored_as_scd_type=2,
                      except_columns=EVENT_EXCEPT, ignore_null_updates=True,
                      apply_as_deletes=DELETE_WHEN)
    return apply_changes(src, spec)
