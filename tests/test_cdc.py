"""Change-data apply: unit cases, properties, batch-split invariance."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimsmith.operators.cdc import ChangeSpec, apply_changes
from dimsmith.operators.ordered import next_within_key
from dimsmith.streaming.apply_changes import merge_batch, visible

SCHEMA = "id int, seq timestamp, name string, op string"


def ts(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def feed(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [
    (6, ts(1), "a", "upsert"),
    (6, ts(3), "b", "upsert"),
    (6, ts(2), "late", "upsert"),     # older row arriving later
    (7, ts(1), "x", "upsert"),
    (7, ts(2), None, "upsert"),      # NULL update
    (8, ts(1), "p", "upsert"),
    (8, ts(4), None, "delete"),
]


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, x) if x is not None else (True, 0) for x in t))


def test_scd1_latest_wins_and_late_rows_ignored(spark):
    out = apply_changes(feed(spark, ROWS), ChangeSpec(["id"], "seq", 1, except_columns=["op"]))
    assert rows(out, "id", "name") == [(6, "b"), (7, None), (8, None)]


def test_scd1_ignore_null_updates(spark):
    spec = ChangeSpec(["id"], "seq", 1, except_columns=["op"], ignore_null_updates=True)
    out = apply_changes(feed(spark, ROWS), spec)
    assert rows(out, "id", "name") == [(6, "b"), (7, "x"), (8, "p")]


def test_scd1_delete_removes_key(spark):
    spec = ChangeSpec(["id"], "seq", 1, except_columns=["op"], apply_as_deletes="op = 'delete'")
    out = apply_changes(feed(spark, ROWS), spec)
    assert [r.id for r in out.collect()] and 8 not in {r.id for r in out.collect()}


def test_scd2_splices_late_rows(spark):
    out = apply_changes(feed(spark, ROWS), ChangeSpec(["id"], "seq", 2, except_columns=["op"]))
    got = rows(out.where("id = 6"), "name", "start_at", "end_at")
    assert got == [("a", ts(1), ts(2)), ("b", ts(3), None), ("late", ts(2), ts(3))]


def test_scd2_delete_closes_version(spark):
    spec = ChangeSpec(["id"], "seq", 2, except_columns=["op"], apply_as_deletes="op = 'delete'")
    out = apply_changes(feed(spark, ROWS), spec)
    assert rows(out.where("id = 8"), "name", "start_at", "end_at") == [("p", ts(1), ts(4))]


def test_truncate_drops_everything_before(spark):
    data = ROWS + [(9, ts(2, 12), None, "truncate")]
    spec = ChangeSpec(["id"], "seq", 2, except_columns=["op"], apply_as_truncates="op = 'truncate'")
    out = apply_changes(feed(spark, data), spec)
    assert rows(out, "id", "name") == [(6, "b"), (8, None)]


def test_tiebreak_on_equal_sequence(spark):
    data = [(1, ts(1), "lo", "a"), (1, ts(1), "hi", "b")]
    spec = ChangeSpec(["id"], "seq", 1, tiebreak=["op"])
    assert rows(apply_changes(feed(spark, data), spec), "name") == [("hi",)]


def _random_feed(spark, n=400, keys=12, seed=7):
    rnd = random.Random(seed)
    seqs = rnd.sample(range(10_000), n)
    data = [(rnd.randrange(keys), dt.datetime(2024, 1, 1) + dt.timedelta(hours=s),
             f"v{rnd.randrange(50)}", "delete" if rnd.random() < 0.1 else "upsert") for s in seqs]
    return feed(spark, data)


def test_scd2_properties(spark):
    out = apply_changes(_random_feed(spark), ChangeSpec(["id"], "seq", 2, except_columns=["op"]))
    # intervals per key are gap-free and disjoint; exactly one open version per key
    w = Window.partitionBy("id").orderBy("start_at")
    bad = out.withColumn("nxt", F.lead("start_at").over(w)).where(
        ~F.col("end_at").eqNullSafe(F.col("nxt")))
    assert bad.count() == 0
    assert out.where("end_at IS NULL").groupBy("id").count().where("count <> 1").count() == 0


def test_scd1_equals_open_scd2(spark):
    src = _random_feed(spark)
    s1 = apply_changes(src, ChangeSpec(["id"], "seq", 1, except_columns=["op"]))
    s2 = apply_changes(src, ChangeSpec(["id"], "seq", 2, except_columns=["op"]))
    assert rows(s1, "id", "name") == rows(s2.where("end_at IS NULL"), "id", "name")


def _split_apply(spark, src, spec, parts, seed):
    pieces = src.withColumn("_p", (F.xxhash64("seq", F.lit(seed)) % parts + parts) % parts)
    prev = None
    for p in range(parts):
        batch = pieces.where(F.col("_p") == p).drop("_p")
        prev = merge_batch(prev, batch, spec).checkpoint()
    return visible(prev, spec)


def test_batch_split_invariance(spark):
    src = _random_feed(spark)
    for scd in (1, 2):
        spec = ChangeSpec(["id"], "seq", scd, except_columns=["op"], apply_as_deletes="op = 'delete'")
        whole = apply_changes(src, spec)
        cols = whole.columns
        for parts, seed in ((2, 1), (4, 2)):
            split = _split_apply(spark, src, spec, parts, seed)
            assert rows(split, *cols) == rows(whole, *cols), (scd, parts)


def test_replaying_a_batch_changes_nothing(spark):
    src = _random_feed(spark)
    spec = ChangeSpec(["id"], "seq", 2, except_columns=["op"], apply_as_deletes="op = 'delete'")
    once = merge_batch(None, src, spec).checkpoint()
    twice = merge_batch(once, src, spec)
    assert rows(twice, *once.columns) == rows(once, *once.columns)


def test_next_within_key_hot_key_matches_window(spark):
    # one key holds most rows, spread over many day buckets
    base = dt.datetime(2024, 1, 1)
    data = [(0 if i % 4 else i % 7, base + dt.timedelta(minutes=37 * i), f"n{i}", "u")
            for i in range(3000)]
    df = feed(spark, data)
    got = next_within_key(df, ["id"], ["seq"], ["name"], prefix="nx_", bucket_unit="day")
    w = Window.partitionBy("id").orderBy("seq")
    want = df.select("id", "seq", F.lead("seq").over(w).alias("nx_seq"),
                     F.lead("name").over(w).alias("nx_name"))
    assert rows(got, "id", "seq", "nx_seq", "nx_name") == rows(want, "id", "seq", "nx_seq", "nx_name")


def test_fill_within_key_hot_key_matches_window(spark):
    from dimsmith.operators.ordered import fill_within_key
    base = dt.datetime(2024, 1, 1)
    data = [(0 if i % 5 else i % 3, base + dt.timedelta(minutes=53 * i),
             None if (i % 7) else f"n{i}", "u") for i in range(3000)]
    df = feed(spark, data)
    got = fill_within_key(df, ["id"], ["seq"], ["name"], bucket_unit="day")
    w = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("name", F.last("name", ignorenulls=True).over(w))
    assert rows(got, "id", "seq", "name") == rows(want, "id", "seq", "name")


def test_numeric_sequence_with_default_bucket(spark):
    data = [(1, 10 * i, f"v{i}") for i in range(50)] + [(2, 3_000_000 + i, "w") for i in range(3)]
    df = spark.createDataFrame(data, "id int, n bigint, name string")
    out = apply_changes(df, ChangeSpec(["id"], "n", 2))
    got = rows(out.where("id = 2"), "start_at", "end_at")
    assert got == [(3_000_000, 3_000_001), (3_000_001, 3_000_002), (3_000_002, None)]


def test_target_snapshots_are_whole_and_replay_cleanly(spark):
    import os
    import tempfile

    from dimsmith.sinks.files import drop_snapshots
    from dimsmith.streaming.apply_changes import merge_into_target, read_target

    root = tempfile.mkdtemp(prefix="dimsmith-target-") + "/target"
    src = _random_feed(spark, n=300, keys=40)
    spec = ChangeSpec(["id"], "seq", 2, except_columns=["op"], apply_as_deletes="op = 'delete'")
    merge_into_target(spark, src, spec, root, 0, files=3)
    assert len([f for f in os.listdir(f"{root}/data/v=0") if f.endswith(".parquet")]) == 3
    whole = apply_changes(src, spec)
    cols = whole.columns
    assert rows(read_target(spark, root, spec), *cols) == rows(whole, *cols)
    one = feed(spark, [(3, dt.datetime(2030, 1, 1), "late", "upsert")])
    assert merge_into_target(spark, one, spec, root, 1) >= 1
    assert merge_into_target(spark, one, spec, root, 1) is None          # replay: no change
    expect = apply_changes(src.unionByName(one), spec)
    assert rows(read_target(spark, root, spec), *cols) == rows(expect, *cols)
    # a snapshot that was not completed is not read, and is replaced by the replay
    late = feed(spark, [(3, dt.datetime(2031, 1, 1), "later", "upsert"), (5, dt.datetime(2031, 1, 1), "x", "upsert")])
    merge_into_target(spark, late, spec, root, 2)
    os.remove(f"{root}/data/v=2/_SUCCESS")
    assert rows(read_target(spark, root, spec), *cols) == rows(expect, *cols)
    merge_into_target(spark, late, spec, root, 2)
    both = apply_changes(src.unionByName(one).unionByName(late), spec)
    assert rows(read_target(spark, root, spec), *cols) == rows(both, *cols)
    assert drop_snapshots(spark, f"{root}/data", keep=1) == 2
    assert rows(read_target(spark, root, spec), *cols) == rows(both, *cols)


def _in_batches(spark, parts, spec, **options):
    import tempfile

    from dimsmith.streaming.apply_changes import merge_into_target, read_target
    root = tempfile.mkdtemp(prefix="dimsmith-batches-") + "/target"
    for i, part in enumerate(parts):
        merge_into_target(spark, part, spec, root, i, **options)
    return read_target(spark, root, spec)


@pytest.mark.parametrize("scd", [1, 2])
@pytest.mark.parametrize("nulls", [False, True])
def test_truncate_holds_across_batches(spark, scd, nulls):
    day = lambda d: dt.datetime(2024, 1, d)
    data = [(1, day(1), "a", "upsert"), (2, day(2), None, "upsert"), (1, day(3), "x", "truncate"),
            (2, day(4), "late", "upsert"), (1, day(2), "old", "upsert"), (3, day(5), None, "upsert"), (2, day(6), None, "upsert")]
    src = feed(spark, data)
    spec = ChangeSpec(["id"], "seq", scd, except_columns=["op"], apply_as_truncates="op = 'truncate'",
                      ignore_null_updates=nulls)
    whole = apply_changes(src, spec)
    for cut in (2, 3, 5):
        for flip in (False, True):
            parts = [feed(spark, data[:cut]), feed(spark, data[cut:])]
            got = _in_batches(spark, parts[::-1] if flip else parts, spec)
            assert rows(got, *whole.columns) == rows(whole, *whole.columns), (cut, flip)


@pytest.mark.parametrize("scd", [1, 2])
def test_tie_break_and_null_keys_across_batches(spark, scd):
    day = lambda d: dt.datetime(2024, 1, d)
    data = [(1, day(1), "old", "a"), (1, day(1), "new", "b"), (None, day(1), "n1", "a"), (None, day(2), "n2", "a"),
            (None, day(2), "n3", "c"), (2, day(5), "z", "a")]
    spec = ChangeSpec(["id"], "seq", scd, tiebreak=["op"])
    whole = apply_changes(feed(spark, data), spec)
    assert whole.where("id IS NULL").count() == scd
    for parts in ([data[:1], data[1:]], [data[1:], data[:1]], [[x] for x in data], [[x] for x in reversed(data)]):
        got = _in_batches(spark, [feed(spark, p) for p in parts], spec)
        assert rows(got, *whole.columns) == rows(whole, *whole.columns)


def test_incremental_ignore_nulls_is_split_invariant(spark):
    rnd = random.Random(11)
    seqs = rnd.sample(range(5000), 300)
    data = [(rnd.randrange(10), dt.datetime(2024, 1, 1) + dt.timedelta(hours=s),
             None if rnd.random() < 0.4 else f"v{rnd.randrange(30)}",
             "delete" if rnd.random() < 0.08 else "upsert") for s in seqs]
    src = feed(spark, data)
    for scd in (1, 2):
        for deletes in ("op = 'delete'", None):
            spec = ChangeSpec(["id"], "seq", scd, except_columns=["op"], ignore_null_updates=True,
                              apply_as_deletes=deletes)
            whole = apply_changes(src, spec)
            cols = whole.columns
            for parts, seed in ((3, 5), (5, 9)):
                split = _split_apply(spark, src, spec, parts, seed)
                assert rows(split, *cols) == rows(whole, *cols), (scd, deletes, parts)


def test_trace_key_across_layers(spark):
    from dimsmith.plans.eventlog import trace_key
    src = feed(spark, ROWS)
    s1 = apply_changes(src, ChangeSpec(["id"], "seq", 1, except_columns=["op"]))
    s2 = apply_changes(src, ChangeSpec(["id"], "seq", 2, except_columns=["op"]))
    t = trace_key({"bronze": src, "scd1": s1, "scd2": s2}, "id = 6", order_by="seq").collect()
    assert [r.table for r in t] == ["bronze"] * 3 + ["scd1"] + ["scd2"] * 3
    assert [r.seq for r in t[:3]] == [ts(1), ts(2), ts(3)]
