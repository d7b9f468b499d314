"""Keys, SCD 2 merge (golden case), temporal joins, calendar, generator, ranks."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from dimsmith.operators.generate import seed_days
from dimsmith.operators.latest import latest_by
from dimsmith.operators.keys import assign_durable_keys, assign_surrogate_keys
from dimsmith.operators.ordered import global_rank, row_number_within
from dimsmith.operators.reports import rollup_with_totals
from dimsmith.operators.scd import DimSpec, current_view, duplicate_keys, scd2_merge
from dimsmith.operators.temporal import as_of, temporal_join
from dimsmith.sources.calendar import calendar_from_offsets

D = dt.date
OPEN = D(9999, 12, 31)
SPEC = DimSpec(business_keys=["depot", "unit"], attributes=["label", "grade"])
DIM_DDL = ("sk bigint, dk bigint, depot string, unit string, label string, grade string, "
           "valid_from date, valid_to date, is_current boolean")


def history(sk, dk, depot, unit, label, steps):
    """Versions of one member: (start, grade) steps, each ending the day before the next."""
    ends = [s - dt.timedelta(days=1) for s, _ in steps[1:]] + [OPEN]
    return [(sk + i, dk, depot, unit, label, grade, start, end, end == OPEN)
            for i, ((start, grade), end) in enumerate(zip(steps, ends, strict=True))]


# Machines of two depots: one with three versions, one that stays as it is, one
# that the updates do not mention and one that is regraded.
DIM_ROWS = (
    history(1, 1, "east", "pump", "Feed pump", [(D(2011, 2, 3), "C"), (D(2012, 6, 9), "B"), (D(2014, 1, 20), "A")])
    + history(4, 2, "east", "valve", "Inlet valve", [(D(2013, 5, 5), "B")])
    + history(5, 3, "west", "pump", "Drain pump", [(D(2010, 10, 1), "D"), (D(2015, 3, 3), "C")])
    + history(7, 4, "west", "fan", "Roof fan", [(D(2012, 12, 12), "D"), (D(2013, 1, 1), "B")]))
UPDATES = [("east", "pump", "Feed pump", "A+"), ("east", "valve", "Inlet valve", "B"),
           ("west", "fan", "Roof fan", "A"), ("east", "belt", "Sorter belt", "C")]
UPD_DDL = "depot string, unit string, label string, grade string"
RUN = D(2016, 9, 14)


def test_scd2_merge_golden_case(spark):
    dim = spark.createDataFrame(DIM_ROWS, DIM_DDL)
    upd = spark.createDataFrame(UPDATES, UPD_DDL)
    out = scd2_merge(dim, upd, SPEC, RUN).checkpoint()
    rows = {(r.depot, r.unit, r.valid_from): r for r in out.collect()}
    # two members regraded (one row closed, one added each), one new member
    assert len(rows) == 8 + 2 + 1
    assert out.where("is_current").count() == 5
    closed = rows[("east", "pump", D(2014, 1, 20))]
    assert (closed.valid_to, closed.is_current) == (D(2016, 9, 13), False)
    opened = rows[("east", "pump", RUN)]
    assert (opened.dk, opened.grade, opened.valid_to, opened.is_current) == (1, "A+", OPEN, True)
    assert rows[("west", "fan", RUN)].dk == 4
    belt = rows[("east", "belt", RUN)]
    assert belt.dk == 5 and belt.sk > 8
    assert sorted(r.sk for r in out.collect()) == list(range(1, 12))
    assert rows[("west", "pump", D(2015, 3, 3))].is_current          # not in the updates
    assert rows[("east", "valve", D(2013, 5, 5))].valid_to == OPEN   # unchanged
    # a second run with the same updates changes nothing
    again = scd2_merge(out, upd, SPEC, RUN)
    cols = out.columns
    assert sorted(tuple(r) for r in again.select(*cols).collect()) == \
        sorted(tuple(r) for r in out.select(*cols).collect())
    assert duplicate_keys(out, SPEC.business_keys, F.col("is_current")).count() == 0
    assert duplicate_keys(out, ["dk"], F.col("is_current")).count() == 0


def test_scd2_merge_null_keys_and_flags(spark):
    """A NULL key part is a key like any other; a NULL flag means not current."""
    rows = [(1, 1, None, "a", "n", "X", D(2015, 1, 1), OPEN, True), (2, 2, "d", None, "n", "X", D(2015, 1, 1), OPEN, True),
            (3, 3, "d", "old", "n", "X", D(2015, 1, 1), D(2015, 12, 31), None)]
    upd = [(None, "a", "n", "Y"), ("d", None, "n", "X"), (None, None, "n", "Z")]
    out = scd2_merge(spark.createDataFrame(rows, DIM_DDL), spark.createDataFrame(upd, UPD_DDL), SPEC, RUN).collect()
    got = sorted((r.depot or "", r.unit or "", r.grade, r.dk, bool(r.is_current)) for r in out)
    assert got == [("", "", "Z", 4, True), ("", "a", "X", 1, False), ("", "a", "Y", 1, True), ("d", "", "X", 2, True),
                   ("d", "old", "X", 3, False)]


def test_scd2_merge_same_day_replaces(spark):
    dim = spark.createDataFrame([(1, 1, "W", "a", "n", "A", RUN, OPEN, True)], DIM_DDL)
    upd = spark.createDataFrame([("W", "a", "n", "B")], UPD_DDL)
    out = scd2_merge(dim, upd, SPEC, RUN).collect()
    assert len(out) == 1 and out[0].grade == "B" and out[0].sk == 1


def test_scd2_merge_closed_key_left_alone_unless_reopen(spark):
    dim = spark.createDataFrame([(1, 1, "W", "a", "n", "A", D(2015, 1, 1), D(2015, 12, 31), False)],
                                DIM_DDL)
    upd = spark.createDataFrame([("W", "a", "n", "B")], UPD_DDL)
    assert scd2_merge(dim, upd, SPEC, RUN).count() == 1
    reopened = scd2_merge(dim, upd, SPEC, RUN, reopen=True)
    assert reopened.where("is_current").select("grade", "dk").collect()[0] == ("B", 1)


def test_current_view(spark):
    dim = spark.createDataFrame(DIM_ROWS, DIM_DDL)
    cur = current_view(dim, SPEC).collect()
    assert len(cur) == 4 and {r.dk for r in cur} == {1, 2, 3, 4}
    assert "current_grade" in cur[0].asDict()


def test_durable_and_surrogate_keys(spark):
    dim = spark.createDataFrame(DIM_ROWS, DIM_DDL).drop("sk", "dk")
    keyed = assign_surrogate_keys(assign_durable_keys(dim, ["depot", "unit"]),
                                  ["depot", "unit", "valid_from"])
    got = {(r.depot, r.unit, r.valid_from): (r.sk, r.dk) for r in keyed.collect()}
    assert got[("east", "pump", D(2012, 6, 9))] == (2, 1)
    assert got[("west", "fan", D(2012, 12, 12))] == (5, 3)
    assert got[("west", "pump", D(2015, 3, 3))] == (8, 4)
    assert len({v[0] for v in got.values()}) == 8


def test_keys_and_ranks_keep_null_rows(spark):
    rows = [("a", 1), (None, 2), ("b", None), (None, 2), (None, None)]
    df = spark.createDataFrame(rows, "k string, v int")
    dk = assign_durable_keys(df, ["k", "v"]).collect()
    assert len(dk) == 5 and len({r.dk for r in dk}) == 4
    assert sorted(r["rank"] for r in global_rank(df, ["v"]).collect()) == [1, 1, 3, 4, 4]
    assert sorted(r["rank"] for r in global_rank(df, ["v"], method="dense_rank").collect()) == [1, 1, 2, 3, 3]
    assert latest_by(df, ["k"], ["v"], keep="all").count() == 4      # a, b, and NULL with its tie
    one = {(r.k, r.v) for r in latest_by(df, ["k"], ["v"]).collect()}
    assert one == {("a", 1), ("b", None), (None, 2)}
    num = row_number_within(df.dropDuplicates(), ["k"], ["v"])
    assert sorted(r.row_no for r in num.where("k IS NULL").collect()) == [1, 2]


def test_temporal_join_inclusive_and_unmatched_dropped(spark):
    dim = spark.createDataFrame(DIM_ROWS, DIM_DDL).select("depot", "unit", "sk", "valid_from", "valid_to")
    facts = spark.createDataFrame(
        [("east", "pump", D(2012, 6, 8)), ("east", "pump", D(2012, 6, 9)), ("east", "pump", D(2020, 2, 1)),
         ("west", "fan", D(2010, 1, 1)), ("east", "none", D(2014, 1, 1))],
        "dep string, uni string, used_on date")
    for bucket in ("year", "month", None):
        j = temporal_join(facts, dim, [("dep", "depot"), ("uni", "unit")], "used_on", bucket=bucket)
        assert sorted((r.used_on, r.sk) for r in j.collect()) == [
            (D(2012, 6, 8), 1), (D(2012, 6, 9), 2), (D(2020, 2, 1), 3)]
        k = temporal_join(facts, dim, [("dep", "depot"), ("uni", "unit")], "used_on", bucket=bucket,
                          unknown_member={"sk": -1})
        assert sorted(r.sk for r in k.collect()) == [-1, -1, 1, 2, 3]


def test_as_of_picks_version(spark):
    dim = spark.createDataFrame(DIM_ROWS, DIM_DDL)
    then = {(r.depot, r.unit): r.grade for r in as_of(dim, "2014-01-19").collect()}
    assert then[("east", "pump")] == "B" and ("west", "pump") in then


def test_calendar_first_day_and_monday_first(spark):
    cal = calendar_from_offsets(spark, D(2000, 1, 1), 10).orderBy("calendar_date").collect()
    first = cal[0]
    assert first.calendar_date == D(2000, 1, 2) and first.calendar_sk == 20000102
    assert (first.day_in_week, first.day_name, first.is_weekend) == (7, "Sunday", "Y")
    assert cal[1].day_in_week == 1 and cal[1].is_weekend == "N"


def test_frequency_above_year_yields_nothing(spark):
    cal = calendar_from_offsets(spark, D(2019, 12, 31), 800)
    seeds = spark.createDataFrame([(1, 400), (2, 100)], "customer_id int, freq_days int")
    days = seed_days(seeds, cal, F.lit(D(2020, 1, 1)), F.lit(D(2022, 1, 1)))
    counts = {r.customer_id: r["count"] for r in days.groupBy("customer_id").count().collect()}
    assert 1 not in counts and counts[2] == 6


def test_global_rank_matches_window_rank(spark):
    df = spark.range(5000).select(
        (F.col("id") % 37).alias("a"), (F.col("id") % 11).alias("b"), F.col("id"))
    got = global_rank(df, ["a", "b"], out="r", num_partitions=7)
    want = df.withColumn("r", F.rank().over(Window.orderBy("a", "b")))
    dense = global_rank(df, ["a", "b"], out="r", method="dense_rank", num_partitions=5)
    want_d = df.withColumn("r", F.dense_rank().over(Window.orderBy("a", "b")))
    for g, w in ((got, want), (dense, want_d)):
        assert sorted(tuple(r) for r in g.select("id", "r").collect()) == \
            sorted(tuple(r) for r in w.select("id", "r").collect())


def test_row_number_within_matches_window(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 13).alias("g"), F.col("id"))
    got = row_number_within(df, ["g"], ["id"], out="rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    assert sorted(tuple(r) for r in got.select("id", "rn").collect()) == \
        sorted(tuple(r) for r in want.select("id", "rn").collect())


def test_rollup_labels_totals_without_relabelling_nulls(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "y", 3)],
                               "k1 string, k2 string, v int")
    out = rollup_with_totals(df, ["k1", "k2"], [F.sum("v").alias("s")]).collect()
    got = [(r.k1, r.k2, r.s) for r in out]
    assert ("Total", "Total", 6) == got[-1]
    assert ("a", None, 2) in got and ("a", "Total", 3) in got


def test_version_numbers_key_straddles_partitions(spark):
    from dimsmith.operators.ordered import version_numbers
    # key 0 holds most rows, so range partitions split it
    df = spark.range(4000).select(
        F.when(F.col("id") < 3000, 0).otherwise(F.col("id") % 17 + 1).alias("k"), F.col("id"))
    got = version_numbers(df, ["k"], ["id"], row_out="sk", dense_out="dk", num_partitions=9)
    want = df.select("k", "id", F.row_number().over(Window.orderBy("k", "id")).alias("sk"),
                     F.dense_rank().over(Window.orderBy("k")).alias("dk"))
    assert sorted(tuple(r) for r in got.select("k", "id", "sk", "dk").collect()) == \
        sorted(tuple(r) for r in want.collect())


def test_temporal_join_hot_key_bucketed_equals_plain(spark):
    start = D(1995, 1, 1)
    # key 0: a version every 10 days for 8 years; keys 1..9: one version each
    versions = [(0, i, start + dt.timedelta(days=10 * i), start + dt.timedelta(days=10 * i + 9))
                for i in range(292)]
    versions[-1] = (0, 291, versions[-1][2], OPEN)
    versions += [(k, 1000 + k, start, OPEN) for k in range(1, 10)]
    dim = spark.createDataFrame(versions, "key int, sk int, valid_from date, valid_to date")
    facts = spark.range(20000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 10).cast("int").alias("fk"),
        F.date_add(F.lit(start), (F.col("id") % 3000).cast("int")).alias("d"), "id")
    plain = temporal_join(facts, dim, [("fk", "key")], "d", bucket=None)
    for unit in ("year", "month"):
        bucketed = temporal_join(facts, dim, [("fk", "key")], "d", bucket=unit)
        assert sorted((r.id, r.sk) for r in bucketed.collect()) == \
            sorted((r.id, r.sk) for r in plain.collect())
