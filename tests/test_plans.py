"""Physical-plan properties that matter at scale (checked on sf0.001)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from dimsmith.catalog import QUERIES as CATALOG
from tests.conftest import SF_SMALL

# a streaming query's result is a scan of the table it wrote: nothing to see in its plan
QUERIES = {name: build for name, build in entry.queries().items()
           if name in CATALOG and not name.startswith("stream_")}


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(build(spark, SF_SMALL)) for name, build in QUERIES.items()}


def test_no_cartesian_or_nested_loop_joins(plans):
    bad = {n for n, p in plans.items()
           if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad, bad


def test_no_python_udfs(plans):
    bad = {n for n, p in plans.items()
           if "BatchEvalPython" in p or "ArrowEvalPython" in p or "PythonUDF" in p}
    assert not bad, bad


def test_latest_per_key_is_an_aggregate_not_a_key_window(plans):
    for name in ("scd1_events", "latest_version_one", "scd1_deletes"):
        p = plans[name]
        assert "Window" not in p, name
        assert re.search(r"(Hash|Sort)Aggregate", p), name


def test_scd2_window_is_bucketed(plans):
    # the lead() window over the data is partitioned by (key, time bucket), never by the
    # key alone; the one by key runs over one row per key and bucket
    p = plans["scd2_events"]
    leads = re.findall(r"lead\(.*?\) windowspecdefinition\(([^)]*)\)", p)
    assert len(leads) == 2 and re.match(r"_kb#\d+, ts#", leads[0]) and re.match(r"_w\d+#\d+, _w\d+#\d+ ASC", leads[1]), leads
    assert re.search(r"struct\(key, struct\(k0, user_id#\d+L?\), bucket, date_trunc\(day", p)


def test_scans_read_only_needed_columns(plans):
    p = plans["set_parts_join"]
    schema = re.search(r"lineitem.parquet\]\n(?:PushedFilters: .*\n)?ReadSchema: (struct<[^>]*>)",
                       p).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"}


def test_filters_reach_the_scan(plans):
    p = plans["scd1_where_columns"]
    assert re.search(r"PushedFilters: \[[^\]]*event_type", p)


def test_broadcasts_are_bounded(plans):
    # the report broadcasts one year of calendar keys and per-partition tables only
    p = plans["report_as_of_dk"]
    assert "BroadcastExchange" in p
    assert re.search(r"year\(.*\) = 1997", p)   # filtered to one year before broadcast
