"""Digest-based merges, sweep lookups, the stored star, header index."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from dimsmith.operators import scd_diff
from dimsmith.operators.scd import DimSpec, scd2_merge
from dimsmith.operators.scd_diff import BUCKET, DigestedDim
from dimsmith.operators.sweep import hot_ranges, latest_before, sweep_join, with_block
from dimsmith.operators.temporal import temporal_join

OPEN = dt.date(9999, 12, 31)
DIM = DimSpec(business_keys=["site", "item"], attributes=["label", "size"])
DIM_DDL = ("sk bigint, dk bigint, site string, item int, label string, size int, "
           "valid_from date, valid_to date, is_current boolean")
RUN = dt.date(2020, 5, 5)


def depot(n, rng):
    rows = []
    for i in range(1, n + 1):
        key = (rng.choice(["n", "s", None]), i if i % 7 else None) if i % 50 else (None, None)
        if any(r[2:4] == key for r in rows):
            continue
        ended = i % 5 == 0
        rows.append((2 * i, i, *key, f"l{i}", i % 3, dt.date(2019, 1, 1), dt.date(2019, 6, 30), False))
        rows.append((2 * i + 1, i, *key, f"l{i}" if i % 4 else None, 5, dt.date(2019, 7, 1),
                     dt.date(2019, 12, 31) if ended else OPEN, not ended))
    return rows


def as_set(df):
    return sorted(map(tuple, df.select(*DIM.columns()).collect()), key=repr)


def test_digested_merge_equals_the_merge_and_reads_only_what_differs(spark, tmp_path):
    rng = random.Random(1)
    rows = depot(300, rng)
    dim = spark.createDataFrame(rows, DIM_DDL)
    source = [(r[2], r[3], r[4], r[5]) for r in rows if r[8]]
    edits = {10: "new label", 40: None, 77: "x"}
    changed = [(s, i, edits.get(n, lab), z) for n, (s, i, lab, z) in enumerate(source)][5:]      # five keys are gone
    changed += [("new", 1, "a", 1), ("new", 2, None, None)]
    upd = spark.createDataFrame(changed, "site string, item bigint, label string, size int")
    store = DigestedDim(spark, f"{tmp_path}/dim", DIM, buckets=64, fanout=4)
    store.create(dim)
    assert as_set(store.read()) == as_set(dim)
    assert store.merge(dim.where("is_current").select("site", "item", "label", "size"), RUN) == []

    want = as_set(scd2_merge(dim, upd, DIM, RUN))
    differ = store.changed(store._source(upd))
    assert 4 <= len(differ) <= 10
    part = store._read(differ)
    assert "PartitionFilters: [_bucket" in part._jdf.queryExecution().toString()
    files = {r[0] for r in part.select("_metadata.file_path").distinct().collect()}
    assert {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in files} <= set(differ)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/dim/data/*/*.parquet")}
    assert store.merge(upd, RUN) == differ
    assert as_set(store.read()) == want
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/dim/data/*/*.parquet")}
    same = {f for f in before if after.get(f) == before[f]}
    assert same == {f for f in before if int(f.split(f"{BUCKET}=")[1].split("/")[0]) not in differ}
    # the five keys that are gone keep their buckets different; merging again changes nothing
    assert len(store.merge(upd, RUN)) <= 5
    assert as_set(store.read()) == want


def test_a_merge_that_died_is_followed_by_another_snapshot(spark, tmp_path, monkeypatch):
    """Its buckets count as different: keys are not given twice, and values that went back are seen."""
    rows = depot(120, random.Random(4))
    dim = spark.createDataFrame(rows, DIM_DDL)
    first = [(r[2], r[3], r[4], r[5]) for r in rows if r[8]]
    ddl = "site string, item int, label string, size int"
    died = spark.createDataFrame([(s, i, "other" if n % 9 == 0 else lab, z) for n, (s, i, lab, z) in enumerate(first)] + [("new", 1, "a", 1)], ddl)
    after = spark.createDataFrame([*first, ("new", 1, "a", 1), ("new", 2, "b", 2)], ddl)
    later = RUN + dt.timedelta(days=30)
    store = DigestedDim(spark, f"{tmp_path}/dim", DIM, buckets=64, fanout=4)
    store.create(dim)
    write = store._write

    def write_and_die(part):
        write(part)
        raise RuntimeError("lost")
    monkeypatch.setattr(store, "_write", write_and_die)
    with pytest.raises(RuntimeError, match="lost"):
        store.merge(died, RUN)
    monkeypatch.undo()
    store.merge(after, later)
    assert as_set(store.read()) == as_set(scd2_merge(scd2_merge(dim, died, DIM, RUN).checkpoint(), after, DIM, later))
    assert store.changed(store._source(after)) == []


def test_equal_digests_are_resolved_by_columns(spark, tmp_path, monkeypatch):
    rows = depot(120, random.Random(2))
    dim = spark.createDataFrame(rows, DIM_DDL)
    changed = [(r[2], r[3], "other" if i % 9 == 0 else r[4], r[5]) for i, r in enumerate(x for x in rows if x[8])]
    upd = spark.createDataFrame(changed, "site string, item int, label string, size int")
    real = scd_diff._row_hash
    monkeypatch.setattr(scd_diff, "_row_hash", lambda columns, seed: real(columns, seed) if seed == 5 else F.lit(0).cast("long"))
    store = DigestedDim(spark, f"{tmp_path}/dim", DIM, buckets=8)
    store.create(dim)
    assert store.changed(store._source(upd)) == []          # every digest collides
    assert len(store.merge(upd, RUN, verify=True)) >= 5
    assert as_set(store.read()) == as_set(scd2_merge(dim, upd, DIM, RUN))


def test_nulls_change_places(spark, tmp_path):
    """(NULL, x) and (x, NULL) are different rows to a digest."""
    dim = spark.createDataFrame([(1, 1, "a", 1, None, 7, RUN, OPEN, True)], DIM_DDL)
    store = DigestedDim(spark, f"{tmp_path}/dim", DIM, buckets=1)
    store.create(dim)
    for label, size, n in ((None, 7, 0), ("7", None, 1), (None, None, 1)):
        upd = spark.createDataFrame([("a", 1, label, size)], "site string, item int, label string, size int")
        assert len(store.changed(store._source(upd))) == n
    spec = DimSpec(["site"], ["a", "b"])
    df = spark.createDataFrame([(0, "k", None, "x"), (1, "k", "x", None)], f"{BUCKET} int, site string, a string, b string")
    assert scd_diff.leaf_digests(df, spec).select("d1", "d2").distinct().count() == 2


# --- sweep lookups ---------------------------------------------------------------------------

def versions_of(spark, rng, keys, days):
    rows = []
    for k in keys:
        starts = sorted(rng.sample(range(days), rng.randint(1, 6)))
        for a, b in zip(starts, [*starts[1:], None], strict=True):
            end = rng.choice([b - 1, a]) if b else rng.choice([9999, days // 2])
            rows.append((k, f"v{k}-{a}", dt.date(2000, 1, 1) + dt.timedelta(a), dt.date(2000, 1, 1) + dt.timedelta(end)))
    rows += [(None, "null key", dt.date(2000, 1, 1), OPEN), (keys[0], "no end", dt.date(2000, 1, 5), None),
             (keys[1], "backwards", dt.date(2000, 3, 5), dt.date(2000, 3, 1))]
    return spark.createDataFrame(rows, "id int, name string, valid_from date, valid_to date")


@pytest.mark.parametrize("blocks", [2, 3, 64])
def test_sweep_equals_the_temporal_join(spark, blocks):
    rng = random.Random(blocks)
    dim = versions_of(spark, rng, list(range(40)), 300)
    facts = [(i, rng.choice([*range(45), 7, 7, 7, None]), rng.choice([None, *[dt.date(2000, 1, 1) + dt.timedelta(rng.randint(-20, 400))] * 30]))
             for i in range(3000)]
    facts += [(9000 + i, 7, dt.date(2000, 6, 6)) for i in range(2000)]       # a hot key on a hot day
    facts += [(9999, 3, dt.date(2000, 6, 6))] * 3
    f = spark.createDataFrame(facts, "fact bigint, ref bigint, day date").repartition(7)
    columns = ["fact", "ref", "day", "id", "name", "valid_from", "valid_to"]
    for how in ("inner", "left"):
        want = sorted(map(tuple, temporal_join(f, dim, [("ref", "id")], "day", how=how).select(*columns).collect()), key=repr)
        got = sweep_join(f, dim, [("ref", "id")], "day", how=how, blocks=blocks)
        assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == want
    unknown = sweep_join(f, dim, [("ref", "id")], "day", unknown_member={"name": "unknown"}, blocks=blocks)
    assert unknown.count() == len(facts) and unknown.where("name IS NULL").count() == 0
    none = sweep_join(f.limit(0), dim, [("ref", "id")], "day", blocks=blocks)
    assert none.count() == 0 and sweep_join(f, dim.limit(0), [("ref", "id")], "day").count() == 0


def test_a_hot_key_with_many_versions_is_split(spark):
    """100,000 versions of one key within a year: even blocks, no version listed twice."""
    start = F.timestamp_seconds(F.lit(1_000_000_000) + F.col("id") * 300)
    dim = spark.range(100_000).select(F.lit(1).alias("k"), F.col("id").alias("version"), start.alias("valid_from"),
                                      F.timestamp_seconds(F.lit(1_000_000_299) + F.col("id") * 300).alias("valid_to"))
    dim = dim.unionByName(spark.range(50).select((F.col("id") + 2).cast("int").alias("k"), F.col("id").alias("version"), F.timestamp_seconds(
        F.lit(0)).alias("valid_from"), F.timestamp_seconds(F.lit(2_000_000_000)).alias("valid_to")))
    facts = spark.range(30_000).select(F.lit(1).alias("k"), F.col("id"), F.timestamp_seconds(F.lit(1_000_000_007) + F.col("id") * 1000).alias("at"))
    out = sweep_join(facts, dim, ["k"], "at", blocks=32)
    assert out.count() == 30_000 and out.where(F.col("version") != F.floor((F.lit(7) + F.col("id") * 1000) / 300)).count() == 0
    stream = dim.select(F.struct("k").alias("k"), F.col("valid_from").alias("t"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("salt"))
    hot = hot_ranges(stream, 32)
    assert hot.count() == 1
    sizes = [r["count"] for r in with_block(stream, hot, 32).groupBy("part", "piece").count().collect()]
    assert len(sizes) >= 30 and max(sizes) < 3 * 100_050 / 32


def test_latest_before_equals_a_plain_loop(spark):
    rng = random.Random(8)
    others = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *[dt.datetime(2020, 1, rng.randint(1, 28), rng.randint(0, 3))] * 9]), i) for i in range(600)]
    rows = [(i, rng.choice([1, 2, 3, 4, None]), rng.choice([None, *[dt.datetime(2020, 1, rng.randint(1, 28), rng.randint(0, 3))] * 9])) for i in range(300)]
    want = set()
    for i, key, at in rows:
        mine = sorted(((w, n) for k, w, n in others if key is not None and k == key and at and w and w < at), reverse=True)[:3]
        want |= {(i, p, n) for p, (_, n) in enumerate(mine, 1)}
    got = latest_before(spark.createDataFrame(rows, "i int, key int, at timestamp"), spark.createDataFrame(others, "k int, w timestamp, n int"),
                        [("key", "k")], "at", "w", ["n"], k=3)
    found = [(r.i, r.place, r.n) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# --- stored star and catalog -----------------------------------------------------------------

def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_star_prunes_years_and_joins_by_bucket(spark):
    from dimsmith.catalog.star_layout import posted_sales, store_star
    from tests.conftest import SF_SMALL
    names = store_star(spark, SF_SMALL, buckets=4)
    year = F.col("calendar_date").between("1997-01-01", "1997-12-31")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # the dimensions are small here, not on a cluster
    try:
        plan = posted_sales(spark, names, year)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    fact_scan = next(line for line in plan.split("\n") if names.fact in line and "FileScan" in line)
    assert "dynamicpruning" in fact_scan and "Bucketed: true" in fact_scan
    lines = plan.split("\n")
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    below = [line for line in lines[join:] if line.find("- ") >= 0]
    assert not any("Exchange hashpartitioning" in line for line in below), plan      # fact and product meet by bucket
    full = posted_sales(spark, names, F.lit(True)).agg(F.sum("sales")).first()[0]
    some = posted_sales(spark, names, year).agg(F.sum("sales")).first()[0]
    assert 0 < some < full
    years = spark.table(names.fact).select("order_year").distinct().count()
    assert years > 3 and spark.table(names.fact).where("order_year <> order_date_sk div 10000").count() == 0


def test_catalog_tables_and_views(spark, tmp_path):
    from dimsmith.sinks.tables import create_view, save_table, table_properties
    df = spark.range(5).withColumn("b", F.col("id") % 2)
    save_table(df, "layout_test", f"{tmp_path}/t", partition_by=["b"], comment="it's \\ five", properties={"layer": "raw", "a.b": "x'y"})
    told = {r["key"]: r["value"] for r in table_properties(spark.newSession(), "layout_test").collect()}
    assert told["comment"] == "it's \\ five" and told["layer"] == "raw" and told["a.b"] == "x'y"
    assert told["location"].endswith(f"{tmp_path}/t") and told["type"] == "EXTERNAL"
    assert create_view(spark, "layout_test_odd", "SELECT id FROM layout_test WHERE b = 1", "odd ones").count() == 2
    assert spark.newSession().table("layout_test_odd").count() == 2
    with pytest.raises(Exception, match="already exists"):
        save_table(df, "layout_test", f"{tmp_path}/other")
    spark.sql("DROP VIEW layout_test_odd")
    spark.sql("DROP TABLE layout_test")
    assert len(glob.glob(f"{tmp_path}/t/b=*/*.parquet")) >= 2         # external: the files stay


# --- header index ----------------------------------------------------------------------------

def test_headers_of_many_files(spark, tmp_path):
    from dimsmith.sources.files import header_index, read_with_drift
    headers = ["id,name", "name,id", "id,name,extra"]
    os.makedirs(f"{tmp_path}/drop/sub dir+1")
    for i in range(10_000):
        folder = "drop/sub dir+1" if i % 10 == 0 else "drop"
        with open(f"{tmp_path}/{folder}/f {i}%.csv", "w") as out:
            cells = {"id": str(i), "name": f"n{i}", "extra": "e"}
            h = headers[i % 3]
            out.write(h + "\n" + ",".join(cells[c] for c in h.split(",")) + "\n")
    open(f"{tmp_path}/drop/empty.csv", "w").close()
    open(f"{tmp_path}/drop/_hidden.csv", "w").write("x,y\n1,2\n")
    index = header_index(spark, f"{tmp_path}/drop")
    assert {r.header: r.n for r in index.groupBy("header").agg(F.count("*").alias("n")).collect()} == {
        headers[0]: 3334, headers[1]: 3333, headers[2]: 3333}
    got = read_with_drift(spark, [f"{tmp_path}/drop"], {"id": "int", "name": "string"}, options={"header": True})
    assert got.count() == 10_000 and set(got.columns) == {"id", "name", "extra"}
    assert got.where("name = concat('n', id)").count() == 10_000 and got.where("extra = 'e'").count() == 3333


def test_first_line_of_a_file_in_blocks(spark, tmp_path):
    """A file of many blocks: only its own first line is the header."""
    from dimsmith.sources.files import header_index
    os.makedirs(f"{tmp_path}/drop")
    with open(f"{tmp_path}/drop/long.csv", "w") as out:
        out.write("a,b\n" + "".join(f"{i},{i}\n" for i in range(50_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert [r.header for r in header_index(spark, f"{tmp_path}/drop").collect()] == ["a,b"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
