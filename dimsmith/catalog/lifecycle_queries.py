"""Source lifecycle, late rows, failing rules, log paths, tracing, lateral lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimsmith.catalog.cdc_queries import EVENT_EXCEPT, EVENT_KEYS, EVENT_SEQ
from dimsmith.catalog.registry import ORACLE, query, table
from dimsmith.catalog.star import built_once
from dimsmith.catalog.stream_queries import SECOND_RUN, _logged_runs, land
from dimsmith.functions.variant import at, shape, variant_column
from dimsmith.operators.cdc import END_AT, START_AT, ChangeSpec, apply_changes
from dimsmith.operators.sweep import latest_before
from dimsmith.plans.eventlog import flow_metrics, parsed, trace_key
from dimsmith.plans.graph import GraphError, TableGraph
from dimsmith.session import work_dir
from dimsmith.sinks.files import _fs, move_single_file
from dimsmith.sources.files import SOURCE_FILE, read_file_stream
from dimsmith.streaming.ingest import dedupe_within, ingest_files, run_to_end

# ------------------------------------------------------------ source lifecycle
# Files by landing; the third landing is a file with an old name and an old time.
LANDINGS = (("f2", "f3"), ("f4", "f5"), ("f1",))
_FILE_NO = "o_orderkey % 5 + 1"


@query("stream_source_lifecycle", f"""
SELECT 'f' || ({_FILE_NO}) AS file, count(*) AS rows_read, 1::BIGINT AS batches, ({_FILE_NO}) <> 1 AS archived
FROM orders GROUP BY {_FILE_NO}
""")
def stream_source_lifecycle(spark, sf_dir):
    """A1/V2: three landings, one file a micro-batch, read files archived, a late file with an old name and time
    read like any other; each file counted once. (The last file is archived when a later batch begins.)"""
    wd = work_dir(spark, "lifecycle")
    orders = table(spark, sf_dir, "orders")
    fs, _, jvm = _fs(spark, wd)
    cleaner = "spark.sql.streaming.fileSource.cleaner.numThreads"
    before = spark.conf.get(cleaner, None)
    spark.conf.set(cleaner, "0")            # files are moved within the run, not beside it
    try:
        for n, names in enumerate(LANDINGS):
            for i, name in enumerate(names):
                own = orders.where(F.expr(_FILE_NO) == int(name[1:]))
                own.coalesce(1).write.parquet(f"{wd}/staged/{name}")
                path = move_single_file(spark, f"{wd}/staged/{name}", f"{wd}/landing/{name}.parquet")
                days_ago = 30 if name == "f1" else 10 - 2 * n - i
                modified = int(jvm.java.lang.System.currentTimeMillis()) - days_ago * 86_400_000
                fs.setTimes(jvm.org.apache.hadoop.fs.Path(path), modified, -1)
            stream = read_file_stream(spark, f"{wd}/landing", "parquet", schema=orders.schema, max_files=1, max_age="3650d",
                                      archive=f"{wd}/archive")
            # the batch a row came in: files of one batch are written together
            run_to_end(ingest_files(stream.withColumn("batch", F.current_timestamp()), f"{wd}/bronze", f"{wd}/checkpoint"))
    finally:
        if before is None:
            spark.conf.unset(cleaner)
        else:
            spark.conf.set(cleaner, before)
    name = F.regexp_extract(SOURCE_FILE, "([^/]+)[.]parquet$", 1)
    read = spark.read.parquet(f"{wd}/bronze").groupBy(name.alias("file")).agg(
        F.count("*").alias("rows_read"), F.count_distinct("batch").alias("batches"))
    moved = (spark.read.option("recursiveFileLookup", "true").parquet(f"{wd}/archive")
             .select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)[.]parquet$", 1).alias("file")).distinct()
             .withColumn("moved", F.lit(True)))
    return read.join(moved, "file", "left").select(
        "file", "rows_read", "batches", F.coalesce("moved", F.lit(False)).alias("archived"))


# ------------------------------------------------------------ late rows
LATE_DELAY = "2 days"
# Arrival: ten days a part; some events come a part late, some a second time in the next part.
_OWN_PART = "CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN 0 WHEN ts < TIMESTAMP '2024-01-21 00:00:00' THEN 1 ELSE 2 END"


def _arrivals(events):
    own = F.expr(_OWN_PART)
    late = F.when(F.expr("event_id % 10 = 3"), F.least(own + 1, F.lit(2))).otherwise(own)
    once = events.withColumn("part", late)
    again = events.where("event_id % 10 = 5").withColumn("part", F.least(own + 1, F.lit(2)))
    return once.unionByName(again)


@query("stream_late_rows", f"""
WITH arrivals AS (
  SELECT *, CASE WHEN event_id % 10 = 3 THEN least({_OWN_PART} + 1, 2) ELSE {_OWN_PART} END AS part FROM events
  UNION ALL
  SELECT *, least({_OWN_PART} + 1, 2) FROM events WHERE event_id % 10 = 5),
newest AS (SELECT part, max(ts) AS newest FROM arrivals GROUP BY part),
judged AS (
  SELECT a.*, a.ts <= (SELECT date_trunc('milliseconds', max(n.newest)) - INTERVAL 2 DAY FROM newest n WHERE n.part < a.part) IS TRUE AS late
  FROM arrivals a)
SELECT 'kept' AS what, event_type, count(DISTINCT event_id) AS n FROM judged WHERE NOT late GROUP BY event_type
UNION ALL
SELECT 'late', NULL, count(*) FROM judged WHERE late
""")
def stream_late_rows(spark, sf_dir):
    """V5: duplicates dropped in bounded state; rows below the watermark are dropped and counted in the event log."""
    wd = work_dir(spark, "late")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    arrivals = _arrivals(events)
    g = TableGraph(spark, f"{wd}/lake")

    @g.table()
    def distinct_events(ctx):
        src = ctx.spark.readStream.schema(events.schema).parquet(f"{wd}/landed")
        return dedupe_within(src, ["event_id"], "ts", LATE_DELAY)

    for part in range(3):
        land(arrivals.where(F.col("part") == part).drop("part"), f"{wd}/landed")
        g.run()
    kept = g.read("distinct_events").groupBy("event_type").agg(F.count("*").alias("n")).select(
        F.lit("kept").alias("what"), "event_type", "n")
    late = flow_metrics(parsed(g.event_log())).agg(F.sum("late_rows").alias("n")).select(
        F.lit("late").alias("what"), F.lit(None).cast("string").alias("event_type"), "n")
    return kept.unionByName(late)


# ------------------------------------------------------------ paths of VARIANTs
@query("event_log_variant", f"""
WITH runs AS (SELECT 1 AS run, * FROM events WHERE ts < TIMESTAMP '{SECOND_RUN} 00:00:00'
              UNION ALL SELECT 2, * FROM events WHERE ts >= TIMESTAMP '{SECOND_RUN} 00:00:00')
SELECT run, 'bronze_events' AS table_name, count(*) AS num_output_rows, CAST(NULL AS BIGINT) AS dropped_records, 0::BIGINT AS rules FROM runs GROUP BY run
UNION ALL SELECT run, 'checked_events', count(*), 0, 1 FROM runs GROUP BY run
UNION ALL SELECT run, 'silver_events', CAST(count_if(value >= 1) AS BIGINT), CAST(count_if(NOT (value >= 1)) AS BIGINT), 2 FROM runs GROUP BY run
UNION ALL SELECT run, 'user_state', count(DISTINCT user_id), NULL, 0 FROM runs GROUP BY run
""")
def event_log_variant(spark, sf_dir):
    """Every run's flows, the details parsed into a stored VARIANT once and read by path."""
    log = built_once(parsed(_logged_runs(spark, sf_dir)), "event-log")
    return flow_metrics(log).drop("late_rows")


@query("variant_paths", """
SELECT event_type, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS k_total,
       count(*) AS n, count(json_extract(props, '$.absent')) AS absent, 'OBJECT<k: BIGINT>' AS shape
FROM events GROUP BY event_type
""")
def variant_paths(spark, sf_dir):
    """A JSON column stored as VARIANT, read by path, with the common schema of all its values."""
    events = built_once(variant_column(table(spark, sf_dir, "events").select("event_type", "props"), "props"), "event-props")
    return events.groupBy("event_type").agg(
        F.sum(at("props", "k", "bigint")).alias("k_total"), F.count("*").alias("n"),
        F.count(at("props", "absent", "string")).alias("absent"), shape("props").alias("shape"))


# ------------------------------------------------------------ lateral lookups
@query("lateral_latest_before", """
SELECT o.o_orderkey, p.o_orderkey AS earlier_key, p.place
FROM orders o, LATERAL (
  SELECT b.o_orderkey, row_number() OVER (ORDER BY b.o_orderdate DESC, b.o_orderkey DESC)::INTEGER AS place
  FROM orders b WHERE b.o_custkey = o.o_custkey AND b.o_orderdate < o.o_orderdate
  ORDER BY b.o_orderdate DESC, b.o_orderkey DESC LIMIT 2) p
""")
def lateral_latest_before(spark, sf_dir):
    """For each order the customer's last two orders before it: a lateral subquery's order and limit, without its nested loop."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    earlier = orders.select(F.col("o_orderkey").alias("earlier_key"), F.col("o_custkey").alias("customer"),
                            F.col("o_orderdate").alias("earlier_date"))
    return latest_before(orders, earlier, [("o_custkey", "customer")], "o_orderdate", "earlier_date", ["earlier_key"], k=2).select("o_orderkey", "earlier_key", "place")


# ------------------------------------------------------------ refusals
@query("expect_fail", """
SELECT 'priced' AS dataset, false AS failed, count(*) AS n FROM orders WHERE o_totalprice IS NOT NULL
UNION ALL
SELECT 'cheap', count_if(NOT coalesce(o_totalprice < 1000, false)) > 0, CASE WHEN count_if(NOT coalesce(o_totalprice < 1000, false)) > 0 THEN 0 ELSE count(*) END
FROM orders
""")
def expect_fail(spark, sf_dir):
    """D3: a table whose rule holds is written; one with a violated rule aborts its run and nothing of it is readable."""
    wd = work_dir(spark, "expectfail")
    orders, seen = table(spark, sf_dir, "orders"), []
    for name, rule in (("priced", "o_totalprice IS NOT NULL"), ("cheap", "o_totalprice < 1000")):
        g = TableGraph(spark, f"{wd}/{name}")
        g.table(name=name, expect_or_fail={"price": rule})(lambda ctx: orders)
        try:
            g.run()
            seen.append(g.read(name).agg(F.lit(name).alias("dataset"), F.lit(False).alias("failed"), F.count("*").alias("n")))
        except Exception as error:
            if f"expectation price failed on {name}" not in str(error):
                raise
            seen.append(spark.range(1).select(F.lit(name).alias("dataset"), F.lit(True).alias("failed"), F.lit(0).cast("long").alias("n")))
    return seen[0].unionByName(seen[1])


@query("stream_from_overwritten_table", """
SELECT 'a stream needs an append-only source' AS refusal, count(*) AS n FROM orders
""")
def stream_from_overwritten_table(spark, sf_dir):
    """V3: streaming from a full-refresh table is refused with the reason; the table itself stands."""
    g = TableGraph(spark, f"{work_dir(spark, 'overwritten')}/lake")

    @g.table(name="whole")
    def whole(ctx):
        return table(spark, sf_dir, "orders")

    g.run()
    g.table(name="follower")(lambda ctx: ctx.read_stream("whole"))
    refusal = "none"
    try:
        g.run()
    except GraphError as error:
        if "a stream needs an append-only source" in " ".join(str(error).split()):
            refusal = "a stream needs an append-only source"
    return g.read("whole").agg(F.lit(refusal).alias("refusal"), F.count("*").alias("n"))


# ------------------------------------------------------------ tracing
_SCD1, _SCD2 = ORACLE["scd1_events"], ORACLE["scd2_events"]


@query("trace_one_key", f"""
WITH k AS (SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)
SELECT 'bronze' AS "table", user_id, ts, event_id, CAST(NULL AS TIMESTAMP) AS ended FROM events WHERE user_id IN (SELECT * FROM k)
UNION ALL SELECT 'scd1', user_id, ts, event_id, NULL FROM ({_SCD1}) WHERE user_id IN (SELECT * FROM k)
UNION ALL SELECT 'scd2', user_id, start_at, event_id, end_at FROM ({_SCD2}) WHERE user_id IN (SELECT * FROM k)
""")
def trace_one_key(spark, sf_dir):
    """The key with the most events followed through bronze, SCD 1 and SCD 2."""
    events = table(spark, sf_dir, "events")
    key = events.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").select("user_id").first()[0]
    tables = {"bronze": events}
    for scd in (1, 2):
        spec = ChangeSpec(keys=EVENT_KEYS, sequence_by=EVENT_SEQ, stored_as_scd_type=scd, except_columns=EVENT_EXCEPT)
        target = apply_changes(events, spec)
        if scd == 2:
            target = target.withColumnsRenamed({START_AT: "ts", END_AT: "ended"})
        tables[f"scd{scd}"] = target
    return trace_key(tables, f"user_id = {key}", order_by="ts").select("table", "user_id", "ts", "event_id", "ended")
