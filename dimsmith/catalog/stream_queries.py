"""Streaming, incremental apply-changes and declarative-graph queries.

Each query lands copies of the given tables as files in a fresh folder under
the session's checkpoint directory, runs the streaming job(s) to completion
(triggered, ``availableNow``) and returns the resulting table. A feed is landed
in parts (by a hash of a key), each followed by a run, so that the work is done
in several micro-batches; a part has as many files as its data needs. A join of
two streams stays up while its parts land, so that its state is not read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dimsmith.catalog.cdc_queries import (DELETE_WHEN, EVENT_EXCEPT, EVENT_KEYS, EVENT_SEQ,
                                          NULL_WHEN, TRUNCATE_WHEN_SPARK, TRUNCATE_WHEN_SQL)
from dimsmith.catalog.registry import ORACLE, query, table
from dimsmith.operators.cdc import ChangeSpec
from dimsmith.plans.eventlog import quality_by_rule, rows_by_table
from dimsmith.plans.graph import TableGraph
from dimsmith.plans.spec import build_graph, load_spec
from dimsmith.session import work_dir
from dimsmith.sinks.files import move_folder, move_single_file, write_quoted_csv
from dimsmith.sources.files import read_file_stream
from dimsmith.streaming.apply_changes import apply_changes_stream, read_target
from dimsmith.streaming.ingest import (feed_to_end, ingest_files, run_to_end, stream_join,
                                       without_empty_batches)

BATCHES = 3
MANY_BATCHES = 110
POLL = "1 second"       # how often a query that stays up looks for landed files


def hash_part(df, by, part, of=BATCHES):
    return df.where(F.pmod(F.xxhash64(*[F.col(c) for c in by]), F.lit(of)) == part)


def land(df, path, by=None, part=None, of=BATCHES, fmt="parquet", **options):
    """Append ``df``, or the ``part``-th of ``of`` hash parts of it, as files."""
    if part is not None:
        df = hash_part(df, by or df.columns[:1], part, of)
    df.write.mode("append").options(**options).format(fmt).save(path)


def _land_at_once(spark, wd, part, **feeds):
    """A landing: the part of every feed, seen together as ``landed/<part>/<feed>``."""
    def landing():
        for name, df in feeds.items():
            land(df, f"{wd}/staged/{part}/{name}")
        move_folder(spark, f"{wd}/staged/{part}", f"{wd}/landed/{part}")
    return landing


def _landed(spark, wd, feed, df):
    """The stream of one feed's landed parts."""
    return spark.readStream.schema(df.schema).parquet(f"{wd}/landed/*/{feed}")


def _typed(df, like, *more):
    """Cast columns back to the source table's types (CSV inference is coarser)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields], *more)


# ------------------------------------------------------------ apply changes
def _apply_in_parts(spark, feed, spec, name, by, buckets=None):
    """Land the feed part by part, apply each, read the target."""
    wd = work_dir(spark, name)
    for part in range(BATCHES):
        land(feed, f"{wd}/landing", by=by, part=part)
        src = spark.readStream.schema(feed.schema).parquet(f"{wd}/landing")
        run_to_end(apply_changes_stream(src, spec, f"{wd}/target", f"{wd}/_checkpoint", buckets=buckets))
    return read_target(spark, f"{wd}/target", spec)


def _stream_apply(spark, sf_dir, spec, name, buckets=None):
    return _apply_in_parts(spark, table(spark, sf_dir, "events"), spec, name, ["event_id"], buckets)


def _events_with_nulls(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn(
        "value", F.when(F.expr(NULL_WHEN), F.lit(None).cast("double")).otherwise(F.col("value")))


def _events_spec(scd, **kw):
    return ChangeSpec(keys=EVENT_KEYS, sequence_by=EVENT_SEQ, stored_as_scd_type=scd,
                      except_columns=EVENT_EXCEPT, **kw)


@query("stream_scd1", None)
def stream_scd1(spark, sf_dir):
    """S2 incremental: micro-batches in hash order (late rows), same as one batch."""
    return _stream_apply(spark, sf_dir, _events_spec(1), "stream_scd1").select(
        "user_id", "ts", "event_id", "event_type", "value")


@query("stream_scd2", None)
def stream_scd2(spark, sf_dir):
    """S3 incremental: touched keys re-chained, late rows spliced in."""
    return _stream_apply(spark, sf_dir, _events_spec(2), "stream_scd2")


@query("stream_scd1_deletes", None)
def stream_scd1_deletes(spark, sf_dir):
    """S2+S4 incremental with tombstones: a late older row cannot revive a key."""
    spec = _events_spec(1, apply_as_deletes=DELETE_WHEN)
    return _stream_apply(spark, sf_dir, spec, "stream_scd1_del").select(
        "user_id", "ts", "event_id", "event_type", "value")


@query("stream_scd2_deletes", None)
def stream_scd2_deletes(spark, sf_dir):
    """S3+S4 incremental: stored deletes are rebuilt when a key is re-chained."""
    return _stream_apply(spark, sf_dir, _events_spec(2, apply_as_deletes=DELETE_WHEN),
                         "stream_scd2_del")


@query("stream_scd1_ignore_nulls", None)
def stream_scd1_ignore_nulls(spark, sf_dir):
    """S2+S4 incremental IGNORE NULL UPDATES: per-column positions kept in the
    target, so out-of-order batches give the one-shot result."""
    return _apply_in_parts(spark, _events_with_nulls(spark, sf_dir), _events_spec(1, ignore_null_updates=True),
                           "stream_scd1_nn", ["event_id"]).select(
        "user_id", "ts", "event_id", "event_type", "value")


@query("stream_scd2_ignore_nulls", None)
def stream_scd2_ignore_nulls(spark, sf_dir):
    """S3+S4 incremental IGNORE NULL UPDATES on SCD 2: raw change values are
    kept beside the filled ones, so a touched key is re-filled from scratch."""
    return _apply_in_parts(spark, _events_with_nulls(spark, sf_dir), _events_spec(2, ignore_null_updates=True),
                           "stream_scd2_nn", ["event_id"])


@query("stream_scd1_truncate", f"""
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events
  WHERE ts > (SELECT max(ts) FROM events WHERE {TRUNCATE_WHEN_SQL}))
WHERE rn = 1
""")
def stream_scd1_truncate(spark, sf_dir):
    """S2+S4 incremental: the greatest truncate holds for every batch, earlier or later."""
    spec = _events_spec(1, apply_as_truncates=TRUNCATE_WHEN_SPARK)
    return _stream_apply(spark, sf_dir, spec, "stream_scd1_tr").select(
        "user_id", "ts", "event_id", "event_type", "value")


@query("stream_scd2_truncate", None)
def stream_scd2_truncate(spark, sf_dir):
    """S3+S4 incremental truncate on SCD 2."""
    return _stream_apply(spark, sf_dir, _events_spec(2, apply_as_truncates=TRUNCATE_WHEN_SPARK),
                         "stream_scd2_tr")


@query("stream_scd2_ties", """
SELECT user_id, event_id, event_type, value, seq AS start_at,
       lead(seq) OVER (PARTITION BY user_id ORDER BY seq) AS end_at
FROM (SELECT user_id, event_id, event_type, value, date_trunc('day', ts)::TIMESTAMP AS seq,
             row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY event_id DESC) AS rn
      FROM events)
WHERE rn = 1
""")
def stream_scd2_ties(spark, sf_dir):
    """S3/V6: equal sequences in different batches, the greater tie-break wins."""
    feed = table(spark, sf_dir, "events").select(
        "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("seq"), "event_id", "event_type", "value")
    spec = ChangeSpec(["user_id"], "seq", 2, tiebreak=["event_id"])
    return _apply_in_parts(spark, feed, spec, "stream_scd2_ties", ["event_id"])


@query("stream_scd1_null_keys", """
SELECT customer, o_orderkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY customer ORDER BY o_orderkey DESC) AS rn
  FROM (SELECT CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END AS customer, o_orderkey, o_orderpriority
        FROM orders))
WHERE rn = 1
""")
def stream_scd1_null_keys(spark, sf_dir):
    """S2 incremental: rows with a NULL key are one key in every batch."""
    feed = table(spark, sf_dir, "orders").select(
        F.expr("CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END").alias("customer"),
        "o_orderkey", "o_orderpriority")
    return _apply_in_parts(spark, feed, ChangeSpec(["customer"], "o_orderkey", 1), "stream_scd1_null", ["o_orderkey"])


# Bucket count of the targets that name one.
TARGET_BUCKETS = 16


@query("stream_scd1_bucketed", None)
def stream_scd1_bucketed(spark, sf_dir):
    """S2 incremental on a bucket-partitioned target: each batch rewrites only
    the key buckets it touches."""
    return _stream_apply(spark, sf_dir, _events_spec(1), "stream_scd1_b",
                         buckets=TARGET_BUCKETS).select(
        "user_id", "ts", "event_id", "event_type", "value")


@query("stream_scd2_bucketed", None)
def stream_scd2_bucketed(spark, sf_dir):
    """S3+S4 incremental on a bucket-partitioned target (deletes as markers)."""
    return _stream_apply(spark, sf_dir, _events_spec(2, apply_as_deletes=DELETE_WHEN),
                         "stream_scd2_b", buckets=TARGET_BUCKETS)


# ------------------------------------------------------------ file ingest / joins
@query("stream_ingest_csv", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, true AS from_csv FROM customer
""")
def stream_ingest_csv(spark, sf_dir):
    """Incremental CSV ingest, a triggered run per landed
    part, each file once with its name; a non-matching file is skipped by the
    glob filter."""
    wd = work_dir(spark, "ingest")
    cust = table(spark, sf_dir, "customer")
    landed = f"{wd}/landed/csv/Customer"
    opts = {"sep": "|", "header": "true"}
    reader = {"sep": "|", "header": True, "inferSchema": True, "pathGlobFilter": "*.csv"}
    for part in range(2):
        land(cust, landed, by=["c_custkey"], part=part, of=2, fmt="csv", **opts)
        if part == 0:
            cust.select(F.col("c_name").alias("value")).write.mode("append").text(landed)  # noise
        src = read_file_stream(spark, landed, "csv", reader, schema_path=f"{wd}/_schemas/customer")
        run_to_end(ingest_files(src, f"{wd}/bronze", f"{wd}/_checkpoint"))
    bronze = spark.read.parquet(f"{wd}/bronze")
    named = F.col("source_file").endswith(".csv") & F.contains("source_file", F.lit("/landed/csv/Customer/"))
    return _typed(bronze, cust, named.alias("from_csv"))


@query("csv_rescued_values", """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CAST(floor(c_acctbal) AS INTEGER) END AS c_acctbal,
       CASE WHEN c_custkey % 2 = 1 THEN c_acctbal END AS rescued
FROM customer
""")
def csv_rescued_values(spark, sf_dir):
    """A1: a column inferred as int from the first files; values of later files
    that do not fit are kept in the rescued-data column."""
    wd = work_dir(spark, "rescue")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    whole = cust.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.floor("c_acctbal"))
    for feed in (whole, cust.where("c_custkey % 2 = 1")):
        land(feed, f"{wd}/landed", fmt="csv", header="true")
        src = read_file_stream(spark, f"{wd}/landed", "csv", {"header": True, "inferSchema": True},
                               schema_path=f"{wd}/_schema", rescue="_rescued")
        run_to_end(ingest_files(src, f"{wd}/bronze", f"{wd}/_checkpoint"))
    out = spark.read.parquet(f"{wd}/bronze")
    return out.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), F.col("c_acctbal").cast("int").alias("c_acctbal"),
                      F.get_json_object("_rescued", "$.c_acctbal").cast("double").alias("rescued"))


@query("stream_join_inner", """
SELECT o.o_orderkey, o.o_custkey, c.c_name FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
""")
def stream_join_inner(spark, sf_dir):
    """stream–stream inner equi-join. Any order may still meet any later
    customer, so both sides stay in state; bound it with ``watermarks`` where
    the feeds have event times (see ``stream_join_left_watermark``)."""
    wd = work_dir(spark, "sjoin")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o, c = _landed(spark, wd, "orders", orders), _landed(spark, wd, "customer", cust)
    j = stream_join(o, c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "c_name")
    feed_to_end(ingest_files(j, f"{wd}/out", f"{wd}/_checkpoint", available_now=False, processing_time=POLL),
                [_land_at_once(spark, wd, part, orders=hash_part(orders, ["o_orderkey"], part),
                               customer=hash_part(cust, ["c_custkey"], part)) for part in range(BATCHES)])
    return spark.read.parquet(f"{wd}/out")


@query("stream_static_left", """
SELECT o.o_orderkey, c.c_mktsegment FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
""")
def stream_static_left(spark, sf_dir):
    """Enrich a stream with a static dimension (left join, re-read per batch)."""
    wd = work_dir(spark, "sstatic")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    dim = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    for part in range(BATCHES):
        land(orders, f"{wd}/orders", by=["o_orderkey"], part=part)
        o = spark.readStream.schema(orders.schema).parquet(f"{wd}/orders")
        j = stream_join(o, dim, o.o_custkey == dim.c_custkey, how="left").select("o_orderkey", "c_mktsegment")
        run_to_end(ingest_files(j, f"{wd}/out", f"{wd}/_checkpoint"))
    return spark.read.parquet(f"{wd}/out")


# Number of event-time slices landed one after the other, and the event times of the
# marker rows that close the streams: the first moves the watermark past all rows,
# the second lets out what that closed.
SLICES = 5
CLOSING = ("2101-01-01 00:00:00", "2102-01-01 00:00:00")


def _time_slices(times, n=SLICES):
    """Bounds of at most ``n`` half-open ranges of the time column that hold about as many rows each."""
    micros = F.unix_micros(times.columns[0])
    cuts = times.agg(F.percentile_approx(micros, [k / n for k in range(1, n)], 1000)).first()[0]
    cuts = sorted(set(cuts or []))
    return list(zip([None, *cuts], [*cuts, None]))


def _between(df, time, lo, hi):
    """Rows of the years 0 to 9999 in one slice."""
    df = df.where(F.year(time).between(0, 9999))
    df = df if lo is None else df.where(F.unix_micros(time) >= lo)
    return df if hi is None else df.where(F.unix_micros(time) < hi)


@query("stream_join_left_watermark", """
SELECT o.o_orderkey, o.o_orderdate AS o_time, l.l_linenumber, l.l_shipdate AS l_time
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
 AND l.l_shipdate BETWEEN o.o_orderdate - INTERVAL 60 DAY AND o.o_orderdate + INTERVAL 60 DAY
""")
def stream_join_left_watermark(spark, sf_dir):
    """Left outer stream–stream join with watermarks and a time range.

    Both feeds are landed in event-time order, slice by slice, into one query that
    stays up and keeps two slices and the range in its state; marker rows with a
    far later time close them, so every unmatched order comes out."""
    wd = work_dir(spark, "sleft")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_time"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("l_time"))
    near = F.expr("INTERVAL 60 DAYS")
    o = _landed(spark, wd, "orders", orders).withWatermark("o_time", "30 days")
    li = _landed(spark, wd, "lines", lines).withWatermark("l_time", "30 days")
    cond = ((o.o_orderkey == li.l_orderkey) & (li.l_time >= o.o_time - near) & (li.l_time <= o.o_time + near))
    j = o.join(li, cond, "left_outer").select("o_orderkey", "o_time", "l_linenumber", "l_time")

    parts = [(_between(orders, "o_time", lo, hi), _between(lines, "l_time", lo, hi))
             for lo, hi in _time_slices(orders.select("o_time"))]
    for at in CLOSING:
        time = F.lit(at).cast("timestamp")
        parts.append((spark.range(1).select(F.lit(-1).cast("bigint").alias("o_orderkey"), time.alias("o_time")),
                      spark.range(1).select(F.lit(-2).cast("bigint").alias("l_orderkey"), F.lit(0).alias("l_linenumber"),
                                            time.alias("l_time"))))
    with without_empty_batches(spark):
        query = ingest_files(j, f"{wd}/out", f"{wd}/_checkpoint", available_now=False, processing_time=POLL)
    feed_to_end(query, [_land_at_once(spark, wd, k, orders=a, lines=b) for k, (a, b) in enumerate(parts)])
    out = spark.read.parquet(f"{wd}/out").where("o_orderkey >= 0")
    return out.select("o_orderkey", F.col("o_time").cast("timestamp_ntz").alias("o_time"), "l_linenumber",
                      F.col("l_time").cast("timestamp_ntz").alias("l_time"))


# ------------------------------------------------------------ declarative graphs
ORDER_RULES = {"price_positive": "o_totalprice > 0"}
ORDER_DROP = {"status_known": "o_orderstatus IN ('F', 'O')"}


def _orders_graph(spark, sf_dir, wd, files=None):
    orders = table(spark, sf_dir, "orders")
    landed = f"{wd}/landed/orders"
    if files:       # many micro-batches: one small file each
        orders.repartition(files, "o_orderkey").write.parquet(landed)
    else:
        land(orders, landed)
    g = TableGraph(spark, f"{wd}/lake")

    @g.table(properties={"layer": "bronze"})
    def bronze_orders(ctx):
        reader = ctx.spark.readStream.schema(orders.schema)
        return (reader.option("maxFilesPerTrigger", 1) if files else reader).parquet(landed)

    @g.table(properties={"layer": "silver"}, expect=ORDER_RULES, expect_or_drop=ORDER_DROP)
    def silver_orders(ctx):
        return ctx.read_stream("bronze_orders")

    return g, orders


@query("stream_expect_counts", """
SELECT 'silver_orders' AS dataset, 'price_positive' AS expectation,
       CAST(count_if(o_totalprice > 0) AS BIGINT) AS passing_records,
       CAST(count_if(NOT COALESCE(o_totalprice > 0, false)) AS BIGINT) AS failing_records FROM orders
UNION ALL
SELECT 'silver_orders', 'status_known', CAST(count_if(o_orderstatus IN ('F', 'O')) AS BIGINT),
       CAST(count_if(NOT COALESCE(o_orderstatus IN ('F', 'O'), false)) AS BIGINT) FROM orders
""")
def stream_expect_counts(spark, sf_dir):
    """Expectation counts observed on micro-batches, summed per run
    into the event log, read back with the last-run quality report."""
    g, _ = _orders_graph(spark, sf_dir, work_dir(spark, "sexpect"))
    g.run()
    return quality_by_rule(g.event_log())


@query("stream_expect_counts_many", None)
def stream_expect_counts_many(spark, sf_dir):
    """D1/D2/L1 over more micro-batches than Spark keeps reports of."""
    g, _ = _orders_graph(spark, sf_dir, work_dir(spark, "sexpectmany"), files=MANY_BATCHES)
    g.run()
    return quality_by_rule(g.event_log())


_CLEAN_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus IN ('F', 'O')
"""


@query("stream_full_refresh", _CLEAN_ORDERS)
def stream_full_refresh(spark, sf_dir):
    """V4: a second run reads nothing new; a full refresh rebuilds the streaming
    table from all files with a new checkpoint — no duplicates."""
    g, orders = _orders_graph(spark, sf_dir, work_dir(spark, "srefresh"))
    g.run()
    g.run()
    g.run(full_refresh=["silver_orders"])
    return _typed(g.read("silver_orders"), orders)


@query("stream_full_refresh_upstream", _CLEAN_ORDERS)
def stream_full_refresh_upstream(spark, sf_dir):
    """V4: a refreshed table starts the tables that stream from it over, too."""
    g, orders = _orders_graph(spark, sf_dir, work_dir(spark, "srefreshup"))
    g.run()
    g.run(full_refresh=["bronze_orders"])
    g.run()
    return _typed(g.read("silver_orders"), orders)


@query("stream_full_refresh_new_column", """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer
""")
def stream_full_refresh_new_column(spark, sf_dir):
    """V4: files with an added column land; a full refresh takes the column in."""
    wd = work_dir(spark, "srefreshcol")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    g = TableGraph(spark, f"{wd}/lake")

    @g.table()
    def bronze(ctx):
        return ctx.read_files(f"{wd}/landed", "csv", {"header": True, "inferSchema": True})

    @g.table()
    def silver(ctx):
        return ctx.read_stream("bronze")

    land(cust.where("c_custkey % 2 = 0").drop("c_mktsegment"), f"{wd}/landed", fmt="csv", header="true")
    g.run()
    land(cust.where("c_custkey % 2 = 1"), f"{wd}/landed", fmt="csv", header="true")
    g.run(full_refresh=["bronze"])
    return _typed(g.read("silver"), cust)


@query("stream_view_expect", """
SELECT 'recent' AS dataset, 'price_positive' AS expectation,
       CAST(count_if(o_totalprice > 0) AS BIGINT) AS passing_records,
       CAST(count_if(NOT (o_totalprice > 0)) AS BIGINT) AS failing_records FROM orders
UNION ALL
SELECT 'recent', 'status_known', CAST(count_if(o_orderstatus IN ('F', 'O')) AS BIGINT),
       CAST(count_if(NOT (o_orderstatus IN ('F', 'O'))) AS BIGINT) FROM orders
UNION ALL
SELECT 'kept', 'urgent', CAST(count_if(o_orderpriority = '1-URGENT') AS BIGINT),
       CAST(count_if(NOT (o_orderpriority = '1-URGENT')) AS BIGINT) FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def stream_view_expect(spark, sf_dir):
    """B3/D: rules of a streaming view are applied and counted in the run."""
    wd = work_dir(spark, "sviewexpect")
    orders = table(spark, sf_dir, "orders")
    land(orders, f"{wd}/landed")
    g = TableGraph(spark, f"{wd}/lake")

    @g.view(expect=ORDER_RULES, expect_or_drop=ORDER_DROP)
    def recent(ctx):
        return ctx.spark.readStream.schema(orders.schema).parquet(f"{wd}/landed")

    @g.table(expect={"urgent": "o_orderpriority = '1-URGENT'"})
    def kept(ctx):
        return ctx.read_stream("recent")

    g.run()
    return quality_by_rule(g.event_log())


@query("sql_body_stream_join", """
SELECT o.o_orderkey, o.o_totalprice, c.c_name
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
WHERE o.o_totalprice > 1000 AND c.c_name IS NOT NULL
""")
def sql_body_stream_join(spark, sf_dir):
    """A streaming table in SQL over two streaming inputs, with two rules."""
    wd = work_dir(spark, "sqlstream")
    orders, cust = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    land(orders, f"{wd}/orders")
    land(cust, f"{wd}/customer")
    g = TableGraph(spark, f"{wd}/lake")

    @g.table(name="orders_raw")
    def orders_raw(ctx):
        return ctx.spark.readStream.schema(orders.schema).parquet(f"{wd}/orders")

    @g.view(name="customers_raw")
    def customers_raw(ctx):
        return ctx.spark.readStream.schema(cust.schema).parquet(f"{wd}/customer")

    g.sql_table("order_names", """
        SELECT o.o_orderkey, o.o_totalprice, c.c_name
        FROM orders_raw o JOIN customers_raw c ON c.c_custkey = o.o_custkey""",
                streams=["orders_raw", "customers_raw"],
                expect_or_drop={"worth": "o_totalprice > 1000", "named": "c_name IS NOT NULL"})
    g.run()
    return g.read("order_names")


# ------------------------------------------------------------ event log of real runs
# The second run of the log queries takes the events from this day on.
SECOND_RUN = "2024-01-16"
_LATER = f"SELECT * FROM events WHERE ts >= TIMESTAMP '{SECOND_RUN} 00:00:00'"


def _logged_runs(spark, sf_dir):
    """The event log of two runs of one graph: a table without rules, one with
    rules, a view with rules and a change target."""
    wd = work_dir(spark, "slog")
    events = table(spark, sf_dir, "events")
    g = TableGraph(spark, f"{wd}/lake")

    @g.table()
    def bronze_events(ctx):
        return ctx.spark.readStream.schema(events.schema).parquet(f"{wd}/landed")

    @g.view(expect={"value_below_400": "value < 400"})
    def checked_events(ctx):
        return ctx.read_stream("bronze_events")

    @g.table(expect={"user_known": "user_id IS NOT NULL"}, expect_or_drop={"value_at_least_1": "value >= 1"})
    def silver_events(ctx):
        return ctx.read_stream("checked_events")

    g.apply_changes("user_state", source="bronze_events", spec=_events_spec(1))
    later = F.col("ts") >= F.lit(SECOND_RUN).cast("timestamp_ntz")
    for part in (events.where(~later), events.where(later)):
        land(part, f"{wd}/landed")
        g.run()
    return g.event_log()


@query("event_log_quality", f"""
SELECT 'checked_events' AS dataset, 'value_below_400' AS expectation,
       CAST(count_if(value < 400) AS BIGINT) AS passing_records, CAST(count_if(NOT (value < 400)) AS BIGINT) AS failing_records
FROM ({_LATER})
UNION ALL
SELECT 'silver_events', 'user_known', CAST(count_if(user_id IS NOT NULL) AS BIGINT), CAST(count_if(user_id IS NULL) AS BIGINT)
FROM ({_LATER})
UNION ALL
SELECT 'silver_events', 'value_at_least_1', CAST(count_if(value >= 1) AS BIGINT), CAST(count_if(NOT (value >= 1)) AS BIGINT)
FROM ({_LATER})
""")
def event_log_quality(spark, sf_dir):
    """L1-L3: passed / failed records per rule of the last of two real runs."""
    return quality_by_rule(_logged_runs(spark, sf_dir))


@query("event_log_rows", f"""
SELECT 'bronze_events' AS table_name, count(*) AS num_output_rows, CAST(NULL AS BIGINT) AS dropped_records FROM ({_LATER})
UNION ALL
SELECT 'checked_events', count(*), 0 FROM ({_LATER})
UNION ALL
SELECT 'silver_events', CAST(count_if(value >= 1) AS BIGINT), CAST(count_if(NOT (value >= 1)) AS BIGINT) FROM ({_LATER})
UNION ALL
SELECT 'user_state', count(DISTINCT user_id), NULL FROM ({_LATER})
ORDER BY table_name
""")
def event_log_rows(spark, sf_dir):
    """Rows written and dropped per table in the last of two real runs."""
    return rows_by_table(_logged_runs(spark, sf_dir))


SPEC_YAML = """
tables:
  Customer:
    bronze:
      kind: view
      format: csv
      options:
        delimiter: '|'
        header: true
        inferSchema: true
    silver:
      kind: table
      expect:
        segment_known: 'c_mktsegment IS NOT NULL'
      expect_or_drop:
        balance_recorded: 'c_acctbal IS NOT NULL'
  Orders:
    bronze:
      kind: table
      format: csv
      options:
        delimiter: '|'
        header: true
        inferSchema: true
    silver:
      kind: table
      cdc:
        scd_type: 1
        keys: [o_custkey]
        sequence_by: [o_orderdate, o_orderkey]
        except_column_list: [o_totalprice, source_filename]
        buckets: 8
"""

# Two entities that share one landed folder, told apart by file names.
GLOB_YAML = """
tables:
  Nation:
    bronze: {kind: table, format: csv, folder: shared, options: {header: true, inferSchema: true, pathGlobFilter: 'nation*'}}
    silver: {kind: table, expect: {named: 'n_name IS NOT NULL'}}
  Region:
    bronze: {kind: view, format: csv, folder: shared, options: {header: true, inferSchema: true, pathGlobFilter: 'region*'}}
    silver: {kind: table}
"""


@query("yaml_spec_tables", """
SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
""")
def yaml_spec_tables(spark, sf_dir):
    """YAML-described bronze/silver tables (CSV landed, view + table,
    expectations, SCD 1 change-data silver)."""
    wd = work_dir(spark, "yaml")
    landed = f"{wd}/landed"
    orders, cust = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    opts = {"sep": "|", "header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    land(orders, f"{landed}/csv/Orders", fmt="csv", **opts)
    land(cust, f"{landed}/csv/Customer", fmt="csv", **opts)
    g = build_graph(spark, load_spec(SPEC_YAML), landed, f"{wd}/lake")
    g.run()
    silver = g.read("Silver_Orders")
    return silver.select(
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        "o_orderstatus", "o_orderpriority")


@query("yaml_glob_tables", """
SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def yaml_glob_tables(spark, sf_dir):
    """A second spec, several tables from one folder picked by file-name glob."""
    wd = work_dir(spark, "yamlglob")
    for name in ("nation", "region"):
        write_quoted_csv(table(spark, sf_dir, name), f"{wd}/out/{name}", n_files=1)     # 25 and 5 rows
        move_single_file(spark, f"{wd}/out/{name}", f"{wd}/landed/csv/shared/{name}_1.csv")
    g = build_graph(spark, load_spec(GLOB_YAML), f"{wd}/landed", f"{wd}/lake")
    g.run()
    n, r = g.read("Silver_Nation"), g.read("Silver_Region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name", "r_name")


@query("sql_body_table", """
SELECT c.c_custkey, c.c_name, n.n_name FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def sql_body_table(spark, sf_dir):
    """A full-refresh table whose body is SQL over two graph views."""
    g = TableGraph(spark, f"{work_dir(spark, 'sqlbody')}/lake")

    @g.view()
    def customers(ctx):
        return table(spark, sf_dir, "customer")

    @g.view()
    def nations(ctx):
        return table(spark, sf_dir, "nation")

    g.sql_table("customer_nation", """
        SELECT c.c_custkey, c.c_name, n.n_name
        FROM customers c JOIN nations n ON n.n_nationkey = c.c_nationkey""", reads=["customers", "nations"],
                comment="customers with their nation", properties={"layer": "silver"})
    g.run()
    return g.read("customer_nation")


# Incremental results must equal the one-shot batch results.
ORACLE["stream_scd1"] = ORACLE["scd1_events"]
ORACLE["stream_scd2"] = ORACLE["scd2_events"]
ORACLE["stream_scd2_truncate"] = ORACLE["scd2_truncate"]
ORACLE["stream_expect_counts_many"] = ORACLE["stream_expect_counts"]
ORACLE["stream_scd1_deletes"] = ORACLE["scd1_deletes"]
ORACLE["stream_scd2_deletes"] = ORACLE["scd2_events_deletes"]
ORACLE["stream_scd1_bucketed"] = ORACLE["scd1_events"]
ORACLE["stream_scd1_ignore_nulls"] = ORACLE["scd1_ignore_nulls"]
ORACLE["stream_scd2_ignore_nulls"] = ORACLE["scd2_ignore_nulls"]
ORACLE["stream_scd2_bucketed"] = ORACLE["scd2_events_deletes"]
