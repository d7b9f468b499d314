"""Expectations, declarative graph, YAML specs, event log, file ingest."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from dimsmith.plans.eventlog import latest_update_id, quality_by_rule, rows_by_table
from dimsmith.plans.graph import GraphError, TableGraph
from dimsmith.plans.quality import Expectation, apply_expectations, quality_report
from dimsmith.plans.spec import SpecError, build_graph, load_spec
from dimsmith.sources.files import read_file_stream
from dimsmith.streaming.ingest import ingest_files, run_to_end


def fresh(prefix):
    return tempfile.mkdtemp(prefix=f"dimsmith-{prefix}-")


def _data(spark):
    return spark.createDataFrame(
        [(1, 10.0, "F"), (2, -1.0, "O"), (3, None, "X"), (4, 5.0, None)],
        "id int, price double, status string")


def test_null_is_a_violation_and_counts_add_up(spark):
    rules = [Expectation("positive", "price > 0", "warn"),
             Expectation("status_known", "status IN ('F', 'O')", "drop")]
    out, obs = apply_expectations(_data(spark), rules, "t")
    assert sorted(r.id for r in out.collect()) == [1, 2]
    m = obs.get
    assert (m["passed_0"], m["failed_0"]) == (2, 2)
    assert (m["passed_1"], m["failed_1"], m["dropped_records"]) == (2, 2, 2)
    rep = {r.expectation: (r.passed_records, r.failed_records)
           for r in quality_report(_data(spark), rules, "t").collect()}
    assert all(p + f == 4 for p, f in rep.values())


def test_fail_rule_aborts(spark):
    out, _ = apply_expectations(_data(spark), [Expectation("id_small", "id < 3", "fail")], "t")
    with pytest.raises(Exception, match="id_small"):
        out.collect()


def test_stream_from_full_refresh_table_is_rejected(spark):
    g = TableGraph(spark, fresh("v3"))

    @g.table()
    def snapshot(ctx):
        return _data(spark)

    @g.table()
    def downstream(ctx):
        return ctx.read_stream("snapshot")

    with pytest.raises(GraphError, match="append-only"):
        g.run()


def test_cycle_is_rejected(spark):
    g = TableGraph(spark, fresh("cycle"))

    @g.view()
    def a(ctx):
        return ctx.read("b")

    @g.view()
    def b(ctx):
        return ctx.read("a")

    with pytest.raises(GraphError, match="cycle"):
        g.run()


def test_unknown_yaml_key_rejected():
    with pytest.raises(SpecError, match="unknown keys"):
        load_spec("tables:\n  X:\n    bronze: {kind: table, format: csv}\n"
                  "    silver: {kind: table, cdc_config: {}}\n")
    with pytest.raises(SpecError, match="change-data silver must be a table"):
        load_spec("tables:\n  X:\n    bronze: {kind: table, format: csv}\n"
                  "    silver: {kind: view, cdc: {scd_type: 1, keys: [a], sequence_by: b}}\n")


def test_graph_run_writes_event_log_and_streams_incrementally(spark):
    root, landed = fresh("graph"), fresh("landed")
    src = spark.range(100).select(F.col("id").cast("int").alias("id"),
                                  (F.col("id") % 7 - 1).cast("double").alias("price"))
    src.where("id < 50").write.mode("append").parquet(landed)
    g = TableGraph(spark, root)

    @g.table(properties={"layer": "bronze"})
    def bronze(ctx):
        return ctx.spark.readStream.schema(src.schema).parquet(landed)

    @g.table(expect={"non_negative": "price >= 0"}, expect_or_drop={"positive": "price > 0"})
    def silver(ctx):
        return ctx.read_stream("bronze")

    g.run()
    first = g.read("silver").count()
    src.where("id >= 50").write.mode("append").parquet(landed)
    g.run()
    assert g.read("bronze").count() == 100                     # each file once
    assert g.read("silver").count() == src.where("price > 0").count()
    assert first < g.read("silver").count()
    log = g.event_log()
    assert log.where("event_type = 'create_update'").count() == 2
    last = latest_update_id(log).collect()[0].update_id
    q = {r.expectation: (r.passing_records, r.failing_records)
         for r in quality_by_rule(log).collect()}
    late = src.where("id >= 50")
    assert q["positive"] == (late.where("price > 0").count(), late.where("NOT price > 0").count())
    assert {r.table_name: (r.num_output_rows, r.dropped_records) for r in rows_by_table(log).collect()} == {
        "bronze": (50, None), "silver": (late.where("price > 0").count(), late.where("NOT price > 0").count())}
    assert last is not None
    desc = {r.name: r for r in g.describe().collect()}
    assert desc["bronze"].properties == {"layer": "bronze"}
    assert desc["silver"].expectations == ["warn:non_negative", "drop:positive"]
    meta = g.table_metadata("bronze")
    assert meta["properties"] == {"layer": "bronze"} and meta["streaming"]
    assert [e["name"] for e in g.table_metadata("silver")["expectations"]] == \
        ["non_negative", "positive"]
    # full refresh: new checkpoint + new output, same content, no duplicates
    g.run(full_refresh=["silver"])
    assert g.read("silver").count() == src.where("price > 0").count()


def test_yaml_bronze_only_and_provenance(spark):
    landed, lake = fresh("ylanded"), fresh("ylake")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    df.write.option("header", "true").option("sep", "|").csv(f"{landed}/csv/Thing")
    doc = load_spec("tables:\n  Thing:\n    bronze:\n      kind: table\n      format: csv\n"
                    "      options: {delimiter: '|', header: true, inferSchema: true}\n")
    g = build_graph(spark, doc, landed, lake)
    g.run()
    out = g.read("Bronze_Thing").collect()
    assert sorted((r.k, r.v) for r in out) == [(1, "a"), (2, "b")]
    assert all(r.source_filename.endswith(".csv") for r in out)


def test_file_ingest_reads_each_file_once_and_keeps_schema(spark):
    wd = fresh("ingest")
    landed = f"{wd}/landed"
    spark.createDataFrame([(1, "a")], "k int, v string").write.option("header", "true") \
        .mode("append").csv(landed)
    opts = {"header": True, "inferSchema": True}

    def run():
        s = read_file_stream(spark, landed, "csv", opts, schema_path=f"{wd}/schema")
        run_to_end(ingest_files(s, f"{wd}/bronze", f"{wd}/cp"))

    run()
    spark.createDataFrame([(2, "b", "extra")], "k int, v string, w string") \
        .write.option("header", "true").mode("append").csv(landed)
    run()
    bronze = spark.read.parquet(f"{wd}/bronze")
    assert sorted(r.k for r in bronze.collect()) == [1, 2]
    assert "w" not in bronze.columns        # stored schema: drift needs a full refresh
    stored = json.loads(spark.read.text(f"{wd}/schema").collect()[0].value)
    assert [f["name"] for f in stored["fields"]] == ["k", "v"]
    assert os.path.isdir(f"{wd}/cp")


def test_apply_changes_replay_after_crash_is_exactly_once(spark):
    """A batch whose snapshot was written but whose stream commit was lost
    (crash between the two) is replayed on restart and must change nothing."""
    import datetime as dt

    from dimsmith.operators.cdc import ChangeSpec
    from dimsmith.streaming.apply_changes import apply_changes_stream, read_target

    wd = fresh("crash")
    rows = [(k % 5, dt.datetime(2024, 1, 1) + dt.timedelta(hours=k), f"v{k}") for k in range(60)]
    df = spark.createDataFrame(rows, "id int, seq timestamp, name string")
    df.repartition(3, "seq").write.parquet(f"{wd}/landing")
    spec = ChangeSpec(["id"], "seq", 2)

    def run():
        src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1) \
            .parquet(f"{wd}/landing")
        run_to_end(apply_changes_stream(src, spec, f"{wd}/target", f"{wd}/cp"))

    run()
    before = sorted(tuple(r) for r in read_target(spark, f"{wd}/target", spec).collect())
    commits = sorted(int(n) for n in os.listdir(f"{wd}/cp/commits") if n.isdigit())
    last = commits[-1]                              # lose the last commit record
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{wd}/cp/commits/{name}"):
            os.remove(f"{wd}/cp/commits/{name}")
    run()                                          # the last batch is replayed
    after = sorted(tuple(r) for r in read_target(spark, f"{wd}/target", spec).collect())
    assert after == before and len(after) == 60


def test_continuous_mode_keeps_streaming(spark):
    root, landed = fresh("cont"), fresh("contland")
    schema = "id int, v string"
    spark.createDataFrame([(1, "a")], schema).write.mode("append").parquet(landed)
    g = TableGraph(spark, root)

    @g.table()
    def raw(ctx):
        return ctx.spark.readStream.schema(schema).parquet(landed)

    @g.table(expect_or_drop={"has_v": "v IS NOT NULL"})
    def clean(ctx):
        return ctx.read_stream("raw")

    running = g.start(processing_time="1 second")
    try:
        assert set(running) == {"raw", "clean"}
        spark.createDataFrame([(2, "b"), (3, None)], schema).write.mode("append").parquet(landed)
        for _ in range(2):
            running["raw"].processAllAvailable()
            running["clean"].processAllAvailable()
    finally:
        g.stop()
    assert sorted(r.id for r in spark.read.parquet(g.table_path("clean")).collect()) == [1, 2]


def test_stream_fail_rule_aborts_without_commit(spark):
    root, landed = fresh("sfail"), fresh("sfailland")
    spark.createDataFrame([(1, 5.0), (2, -1.0)], "id int, price double") \
        .write.mode("append").parquet(landed)
    g = TableGraph(spark, root)

    @g.table(expect_or_fail={"positive": "price > 0"})
    def strict(ctx):
        return ctx.spark.readStream.schema("id int, price double").parquet(landed)

    with pytest.raises(Exception, match="positive"):
        g.run()
    out = g.table_path("strict")
    assert not os.path.exists(f"{out}/_spark_metadata/0")


def test_left_stream_join_needs_watermark(spark):
    from dimsmith.streaming.ingest import stream_join
    wd = fresh("sleftjoin")
    spark.createDataFrame([(1,)], "k int").write.parquet(f"{wd}/a")
    a = spark.readStream.schema("k int").parquet(f"{wd}/a")
    b = spark.readStream.schema("k int").parquet(f"{wd}/a")
    with pytest.raises(Exception, match="(?i)watermark"):
        j = stream_join(a, b.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), how="left")
        j.writeStream.format("noop").option("checkpointLocation", f"{wd}/cp").start()


def test_counts_do_not_depend_on_how_many_reports_spark_keeps(spark):
    """Every micro-batch counts, also those whose report is no longer kept."""
    root, landed = fresh("many"), fresh("manyland")
    spark.range(40).repartition(12, "id").write.mode("append").parquet(landed)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        g = TableGraph(spark, root)

        @g.table(expect={"even": "id % 2 = 0"}, expect_or_drop={"small": "id < 30"})
        def kept(ctx):
            return ctx.spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(landed)

        g.run()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    q = {r.expectation: (r.passing_records, r.failing_records) for r in quality_by_rule(g.event_log()).collect()}
    assert q == {"even": (20, 20), "small": (30, 10)}
    r = rows_by_table(g.event_log()).first()
    assert (r.num_output_rows, r.dropped_records) == (30, 10)


def test_output_rows_are_rows_written(spark):
    from dimsmith.operators.cdc import ChangeSpec
    root, landed = fresh("written"), fresh("writtenland")
    spark.range(25).select("id", (F.col("id") % 5).alias("k")).write.mode("append").parquet(landed)
    g = TableGraph(spark, root)

    @g.table()
    def filtered(ctx):
        return ctx.spark.readStream.schema("id bigint, k bigint").parquet(landed).where("id < 10")

    @g.table()
    def raw(ctx):
        return ctx.spark.readStream.schema("id bigint, k bigint").parquet(landed)

    g.apply_changes("state", source="raw", spec=ChangeSpec(["k"], "id", 1))
    g.apply_changes("state_b", source="raw", spec=ChangeSpec(["k"], "id", 1), buckets=2)
    g.run()
    assert {r.table_name: r.num_output_rows for r in rows_by_table(g.event_log()).collect()} == {
        "filtered": 10, "raw": 25, "state": 5, "state_b": 5}


def test_batch_view_rules_are_logged_and_unread_views_are_not(spark):
    g = TableGraph(spark, fresh("bview"))

    @g.view(expect_or_drop={"positive": "price > 0"})
    def checked(ctx):
        return _data(spark)

    @g.view(expect={"any": "id > 0"})
    def unread(ctx):
        return _data(spark)

    @g.table()
    def out(ctx):
        return ctx.read("checked")

    g.run()
    assert {(r.dataset, r.expectation, r.passing_records) for r in quality_by_rule(g.event_log()).collect()} == {
        ("checked", "positive", 2)}
    assert g.read("out").count() == 2


def test_sql_bodies_read_the_datasets_they_list(spark):
    g = TableGraph(spark, fresh("sqlnames"))

    @g.view(name="data_in")
    def data_in(ctx):
        return _data(spark)

    @g.table(name="landed")
    def landed(ctx):
        return ctx.spark.readStream.schema(_data(spark).schema).parquet(path)

    path = fresh("sqlnames-in")
    _data(spark).write.mode("append").parquet(path)
    g.sql_table("order", "SELECT id FROM data_in ORDER BY id", reads=["data_in"])
    g.sql_table("by_id", "SELECT id AS `order`, 'FROM landed' AS note FROM data_in ORDER BY id", reads=["data_in"])
    g.sql_table("both", "SELECT s.id FROM landed__stream s JOIN landed t ON t.id = s.id", reads=["landed"], streams=["landed"])
    g.run()
    assert g.read("by_id").count() == 4 and g.read("order").count() == 4 and g.read("both").count() == 4
    bad = TableGraph(spark, fresh("sqlnames"))
    bad.sql_table("x", "SELECT 1 FROM nowhere", reads=["nowhere"])
    with pytest.raises(GraphError, match="unknown dataset nowhere"):
        bad.run()


def test_drift_reads_each_file_by_its_own_header(spark):
    from dimsmith.sources.files import read_with_drift
    d = fresh("drift")
    for name, text in (("a.csv", "id,n\n1,10\n2,x\n"), ("b.csv", "n,id,extra\n30,3,e\n"), ("c.csv", "id,n\n4,40\n")):
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    got = {tuple(r) for r in read_with_drift(spark, [d], {"id": "int", "n": "int"}).select("id", "n", "extra").collect()}
    assert got == {(1, 10, None), (2, None, None), (3, 30, "e"), (4, 40, None)}


def test_rescue_keeps_values_and_lines_that_do_not_fit(spark):
    wd = fresh("rescue")
    os.makedirs(f"{wd}/in")

    def land(name, text):
        with open(f"{wd}/in/{name}", "w") as f:
            f.write(text)

    def run():
        s = read_file_stream(spark, f"{wd}/in", "csv", {"header": True, "inferSchema": True},
                             schema_path=f"{wd}/schema", rescue="_rescued")
        run_to_end(ingest_files(s, f"{wd}/bronze", f"{wd}/cp"))

    land("a.csv", "id,n\n1,10\n")
    run()
    land("b.csv", "id,n\n2,12.5\n3,7,more\n")
    run()
    got = {r.id: (r.n, json.loads(r._rescued) if r._rescued else None) for r in spark.read.parquet(f"{wd}/bronze").collect()}
    assert got[1] == (10, None) and got[2] == (None, {"n": "12.5"})
    assert got[3] == (7, {"_record": "3,7,more"})


def test_current_view_is_registered(spark):
    from dimsmith.operators.scd import DimSpec, create_current_view
    dim = spark.createDataFrame([(1, 1, "k", "A", "2020-01-01", "9999-12-31", True)],
                                "sk bigint, dk bigint, key string, grade string, valid_from string, valid_to string, is_current boolean")
    create_current_view(dim, DimSpec(["key"], ["grade"]), "machines_now")
    assert spark.sql("SELECT current_grade FROM machines_now").first()[0] == "A"
