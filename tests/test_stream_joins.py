"""Stream joins whose feeds land part by part."""

import datetime as dt
import os

import pytest

from dimsmith.catalog import stream_queries
from dimsmith.session import work_dir
from dimsmith.sinks.files import move_folder
from dimsmith.streaming.ingest import feed_to_end, ingest_files


@pytest.fixture
def started(monkeypatch):
    """The streaming queries that a catalog query starts."""
    queries, start = [], stream_queries.ingest_files

    def kept(*args, **kwargs):
        queries.append(start(*args, **kwargs))
        return queries[-1]

    monkeypatch.setattr(stream_queries, "ingest_files", kept)
    return queries


def state_read_back(queries):
    """How often a state was not in memory, but read from the checkpoint."""
    return sum(max((op["customMetrics"]["loadedMapCacheMissCount"] for p in q.recentProgress
                    for op in p.stateOperators), default=0) for q in queries)


def test_left_join_keeps_its_state_over_all_slices(spark, tmp_path, started):
    """Matches at the edge of the range and across slices; unmatched, repeated and undated orders."""
    day = lambda s: dt.datetime.fromisoformat(s) if s else None
    orders = [(1, "1996-12-20"), (2, "1996-12-20"), (3, "1998-12-31"), (3, "1998-12-31"), (4, "2001-01-01"),
              (5, None), (6, "1995-05-05"), (7, "1997-03-01"), (None, "1997-03-01")]
    lines = [(1, 1, "1997-01-10"), (1, 2, "1997-02-18"), (1, 3, "1997-02-19"), (3, 1, "1999-02-01"), (3, 1, "1999-02-01"),
             (4, 1, "2000-11-02"), (4, 2, "2000-11-01"), (5, 1, "1997-01-01"), (7, 1, None), (8, 1, "1997-03-01"),
             (None, 1, "1997-03-01")]
    orders, lines = [(k, day(d)) for k, d in orders], [(k, n, day(d)) for k, n, d in lines]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_shipdate timestamp_ntz") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    want = []
    for k, at in orders:
        if k is not None and at is not None:
            near = [(n, t) for key, n, t in lines if key == k and t is not None and abs(t - at) <= dt.timedelta(days=60)]
            want += [(k, at, n, t) for n, t in near or [(None, None)]]
    got = stream_queries.stream_join_left_watermark(spark, str(tmp_path))
    order = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)
    assert len(started) == 1 and not started[0].isActive     # before: five runs, four of which read the state back
    assert state_read_back(started) == 0
    removed = [p.stateOperators[0].numRowsRemoved for p in started[0].recentProgress if p.stateOperators]
    assert sum(n > 0 for n in removed) > 1                     # slices leave the state before the closing rows


def test_inner_join_keeps_its_state_over_all_parts(spark, tmp_path, started):
    orders = [(k, k % 7 if k % 5 else None) for k in range(60)]
    customers = [(k, f"c{k}") for k in (*range(6), 3, None)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(customers, "c_custkey bigint, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    want = [(k, c, n) for k, c in orders for key, n in customers if c is not None and key == c]
    got = stream_queries.stream_join_inner(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert len(started) == 1 and not started[0].isActive     # before: three runs
    assert state_read_back(started) == 0


def test_a_failing_feed_raises_and_stops_the_query(spark):
    wd = work_dir(spark, "feedfail")
    src = spark.readStream.schema("x string").parquet(f"{wd}/landed/*/feed").selectExpr("CAST(x AS int) AS x")
    query = ingest_files(src, f"{wd}/out", f"{wd}/_checkpoint", available_now=False, processing_time="1 second")

    def landing(part, value):
        def land():
            spark.createDataFrame([(value,)], "x string").write.parquet(f"{wd}/staged/{part}/feed")
            move_folder(spark, f"{wd}/staged/{part}", f"{wd}/landed/{part}")
        return land

    later = []
    with pytest.raises(Exception, match="(?i)cast"):
        feed_to_end(query, [landing(0, "1"), landing(1, "one"), lambda: later.append(1)])
    assert not query.isActive and not later
    assert [r.x for r in spark.read.parquet(f"{wd}/out").collect()] == [1]


def test_a_folder_is_moved_whole_and_never_into_another(spark):
    wd = work_dir(spark, "move")
    for part in (0, 1):
        spark.range(20).repartition(4).write.parquet(f"{wd}/staged/{part}/feed")
    move_folder(spark, f"{wd}/staged/0", f"{wd}/landed/0")
    assert not os.path.exists(f"{wd}/staged/0") and spark.read.parquet(f"{wd}/landed/0/feed").count() == 20
    with pytest.raises(FileExistsError):
        move_folder(spark, f"{wd}/staged/1", f"{wd}/landed/0")
    assert spark.read.parquet(f"{wd}/landed/*/feed").count() == 20
