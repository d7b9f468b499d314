"""Shuffles and tasks of the star's steps, the partitioned sink and the order generator."""

import contextlib
import datetime as dt
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from dimsmith.catalog import star
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_key_numbers_equal_the_plain_windows(spark):
    from dimsmith.operators.ordered import key_numbers
    rows = [(k, d) for k in [None, *range(50)] for d in range(1 + (k or 3) % 7)]
    df = spark.createDataFrame(rows, "k int, d int").repartition(5)
    keys = sorted({k for k, _ in rows}, key=lambda k: (k is not None, k or 0))
    want, first = [], 1
    for i, k in enumerate(keys):
        want.append((k, first, i + 1))
        first += sum(r[0] == k for r in rows)
    got = key_numbers(df, ["k"], "first", "dense", num_partitions=7).collect()
    assert sorted(map(tuple, got), key=lambda r: r[2]) == want
    assert key_numbers(df.where("false"), ["k"], "first", "dense").count() == 0


def test_dimension_days_are_shuffled_once_by_key(spark):
    rows = [(None, 3), (None, 1), (7, 2), (7, 9), (7, 4), (5, 8)]
    days = spark.createDataFrame(rows, "customer_id long, n int").select(
        "customer_id", F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("n")).alias("valid_from"), F.lit("x").alias("category"))
    dim = star.with_keys(days, star.CUSTOMER)
    got = [(r.customer_sk, r.customer_dk, r.customer_id, r.valid_from.day - 1, r.valid_to.year, r.is_current)
           for r in dim.orderBy("customer_sk").collect()]
    assert got == [(1, 1, None, 1, 2020, False), (2, 1, None, 3, 9999, True), (3, 2, 5, 8, 9999, True),
                   (4, 3, 7, 2, 2020, False), (5, 3, 7, 4, 2020, False), (6, 3, 7, 9, 9999, True)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan_of(star.with_keys(days, star.CUSTOMER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "rangepartitioning" not in p
    # the days, the keys' numbers, and the numbers' own small windows: nothing between the join and the window
    assert len(re.findall(r"hashpartitioning\(_key", p)) == 2, p
    assert len(re.findall(r"Window \[lead|Window \[row_number|, lead\(", p)) >= 1


@pytest.mark.parametrize("sweep", [False, True])
def test_customers_are_looked_up_before_lines_join(spark, sweep):
    p = plan_of(star.sales_fact(spark, SF_SMALL, sweep=sweep))
    above = p[:p.index("lineitem.parquet")]
    # lines meet the orders below the product lookup, with the customer's keys found already
    lines_join = [x for x in p.splitlines() if "Join" in x and "l_orderkey" in x and "o_orderkey" in x]
    assert lines_join and above
    lookups = [i for i, x in enumerate(p.splitlines()) if ("o_custkey" in x and "customer_id" in x and "Join" in x) or "o_custkey" in x and "Window" in x]
    join_at = next(i for i, x in enumerate(p.splitlines()) if x in lines_join)
    assert all(i > join_at for i in lookups)


def test_versions_that_ended_before_the_facts_take_no_part(spark):
    from dimsmith.operators.temporal import temporal_join
    d = dt.date
    dim = spark.createDataFrame([(1, d(1990, 1, 1), d(1996, 12, 31), "old"), (1, d(1997, 1, 1), d(9999, 12, 31), "new"),
                                 (2, d(1980, 1, 1), d(9999, 12, 31), "only"), (3, d(1999, 1, 1), d(9999, 12, 31), "late")],
                                "k int, valid_from date, valid_to date, name string")
    facts = spark.createDataFrame([(1, d(1997, 1, 1)), (1, d(1998, 5, 5)), (2, d(1997, 2, 2)), (3, d(1998, 1, 1))], "k int, day date")
    got = temporal_join(facts, dim, ["k"], "day", since=d(1997, 1, 1))
    assert sorted((r.day, r.name) for r in got.collect()) == [(d(1997, 1, 1), "new"), (d(1997, 2, 2), "only"), (d(1998, 5, 5), "new")]
    left = temporal_join(facts, dim, ["k"], "day", how="left", since=d(1997, 1, 1))
    assert sum(r.name is None for r in left.collect()) == 1


def test_buckets_of_the_stored_star_follow_the_lines(spark, monkeypatch):
    from dimsmith.catalog import star_layout
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(star_layout, "LINES_A_BUCKET", -(-lines // 11))
    names = star_layout.store_star(spark, SF_SMALL)
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {names.fact}").collect()}
    assert told["Num Buckets"] == "11"


def test_folders_of_a_partitioned_sink_are_dealt_over_tasks(spark, tmp_path):
    """A few kilobytes in many folders: merged by size, one task would write them all."""
    from dimsmith.sinks.files import write_partitioned_csv
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    df = spark.range(400).select((F.col("id") % 100).alias("color"), "id")
    write_partitioned_csv(df, str(tmp_path / "out"), "color")
    files = [f for _, _, fs in os.walk(tmp_path / "out") for f in fs if f.startswith("part-")]
    assert len(files) == 100        # one a folder
    assert len({f.split("-")[1] for f in files}) >= 6
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == before
    back = spark.read.option("header", "true").csv(str(tmp_path / "out"))
    assert back.count() == 400 and back.where("id % 100 <> color").count() == 0


def test_generated_lines_are_shuffled_once_and_stored_once(spark, monkeypatch):
    from dimsmith.catalog.generate_queries import generated_orders
    frame = type(spark.range(0))

    def no(*a, **b):
        raise AssertionError("checkpoint of the lines")
    monkeypatch.setattr(frame, "checkpoint", no)
    out = generated_orders(spark, SF_SMALL)
    rows = sorted((r.order_id, r.order_line_id, r.customer_id) for r in out.collect())
    # ranks with gaps: an order's id is the number of its first line
    assert [a + b - 1 for a, b, _ in rows] == list(range(1, len(rows) + 1))
