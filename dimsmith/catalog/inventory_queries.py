"""Inventory ETL (latest version → joins → conditional sums), joins, scalars.

The inventory model maps onto the given tables as: sets = customer,
inventories = orders (version = order date, tie-break order key),
inventory parts = line items (part = l_partkey, colour = l_suppkey,
spare when the return flag is 'R').
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dimsmith.catalog.registry import query, table
from dimsmith.functions.scalars import (date_key, day_in_week, md5_draw, money,
                                        null_safe_changed, register_sql_functions)
from dimsmith.operators.same_key import same_key_join
from dimsmith.operators.joins import hinted_join, part_totals, set_parts
from dimsmith.operators.latest import latest_by
from dimsmith.operators.ordered import global_rank
from dimsmith.operators.scd import backfill_from

CUTOFF_COMPACT = "19970531"
ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query("latest_version_one", f"""
SELECT {ORDER_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
""")
def latest_version_one(spark, sf_dir):
    """G1: latest version per key, one row (tie-break greatest order key)."""
    return latest_by(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("latest_version_all", f"""
SELECT {ORDER_COLS} FROM (
  SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS mx FROM orders)
WHERE o_orderdate = mx
""")
def latest_version_all(spark, sf_dir):
    """Latest version per key keeping every tied row."""
    return latest_by(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate"], keep="all")


SQL_SET_PARTS = """
SELECT c.c_custkey, c.c_name, i.o_orderkey AS inventory_id, i.o_orderdate AS inventory_version,
       l.l_partkey AS part_num, l.l_suppkey AS color_id, l.l_quantity AS quantity,
       CASE WHEN l.l_returnflag = 'R' THEN 't' ELSE 'f' END AS is_spare
FROM customer c
JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) AS row_num
      FROM orders) i
  ON i.o_custkey = c.c_custkey AND i.row_num = 1
JOIN lineitem l ON l.l_orderkey = i.o_orderkey
"""


def _set_parts(spark, sf_dir):
    sets = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    inv = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate")
    parts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    j = set_parts(sets, inv, parts, set_key="c_custkey", inv_id="o_orderkey",
                  inv_version="o_orderdate", part_inv="l_orderkey", tiebreak=["o_orderkey"])
    return j.select(
        "c_custkey", "c_name", F.col("o_orderkey").alias("inventory_id"),
        F.col("o_orderdate").alias("inventory_version"),
        F.col("l_partkey").alias("part_num"), F.col("l_suppkey").alias("color_id"),
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") == "R", "t").otherwise("f").alias("is_spare"))


@query("set_parts_join", SQL_SET_PARTS)
def set_parts_join(spark, sf_dir):
    """Sets ⋈ latest inventory (residual row_num = 1) ⋈ parts, renamed."""
    return _set_parts(spark, sf_dir)


@query("conditional_sum", f"""
WITH sp AS ({SQL_SET_PARTS})
SELECT part_num, color_id, SUM(quantity) AS quantity,
       SUM(CASE WHEN is_spare = 't' THEN quantity ELSE 0 END) AS spare_quantity
FROM sp GROUP BY part_num, color_id
""")
def conditional_sum(spark, sf_dir):
    """quantity and spare quantity per (part, colour); no match -> 0."""
    return part_totals(_set_parts(spark, sf_dir), "part_num", "color_id", "quantity", "is_spare")


@query("sql_function_spare_qty", """
SELECT l_partkey AS part_num, l_suppkey AS color_id, SUM(l_quantity) AS quantity,
       SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS spare_quantity
FROM lineitem GROUP BY l_partkey, l_suppkey
""")
def sql_function_spare_qty(spark, sf_dir):
    """The spare-quantity rule as a SQL function (inlined, not a UDF),
    over a parquet path named directly in SQL."""
    register_sql_functions(spark)
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    return spark.sql(f"""
        SELECT l_partkey AS part_num, l_suppkey AS color_id, SUM(l_quantity) AS quantity,
               SUM(spare_quantity(CASE WHEN l_returnflag = 'R' THEN 't' ELSE 'f' END,
                                  l_quantity)) AS spare_quantity
        FROM parquet.`{path}` GROUP BY l_partkey, l_suppkey""")


@query("broadcast_join", """
SELECT c.c_custkey, c.c_name, n.n_name FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def broadcast_join(spark, sf_dir):
    """E5: join with an explicit broadcast side, asked for by the caller (25 nations)."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return hinted_join(cust, nation, cust.c_nationkey == nation.n_nationkey, hint="broadcast").select(
        "c_custkey", "c_name", "n_name")


@query("column_rename_map", """
SELECT n.n_nationkey AS nation_key, n.n_name AS nation_name,
       r.r_regionkey AS region_key, r.r_name AS region_name
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def column_rename_map(spark, sf_dir):
    """Rename map over an alias-qualified join (no duplicate names out)."""
    n = table(spark, sf_dir, "nation").alias("n")
    r = table(spark, sf_dir, "region").alias("r")
    mapping = {"n.n_nationkey": "nation_key", "n.n_name": "nation_name",
               "r.r_regionkey": "region_key", "r.r_name": "region_name"}
    j = n.join(r, F.col("r.r_regionkey") == F.col("n.n_regionkey"))
    return j.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


@query("null_default_label", """
SELECT c.c_custkey, o.o_orderkey, COALESCE(o.o_orderpriority, 'Other') AS priority_label
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
""")
def null_default_label(spark, sf_dir):
    """ISNULL(x, default) after an outer join (customers without orders)."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select(
        "c_custkey", "o_orderkey", F.coalesce("o_orderpriority", F.lit("Other")).alias("priority_label"))


@query("limit_preview", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def limit_preview(spark, sf_dir):
    """H3: the first n rows of a filtered table in a total order."""
    return (table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
            .orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)
            .select("o_orderkey", "o_custkey", "o_totalprice"))


@query("distinct_business_keys", """
SELECT DISTINCT o_custkey FROM orders
""")
def distinct_business_keys(spark, sf_dir):
    """group by without aggregates."""
    return table(spark, sf_dir, "orders").select("o_custkey").dropDuplicates()


@query("column_except", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
""")
def column_except(spark, sf_dir):
    """SELECT * EXCEPT (c_acctbal)."""
    return table(spark, sf_dir, "customer").drop("c_acctbal")


@query("update_from_join", """
SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_name AS nation_name
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def update_from_join(spark, sf_dir):
    """UPDATE … SET col = other.col FROM other (left join, new snapshot)."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation_name"))
    return backfill_from(cust, nation, via="c_nationkey", columns=["nation_name"])


@query("change_detect", """
WITH altered AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_acctbal < 0 THEN 'RESTRICTED' ELSE c_mktsegment END AS c_mktsegment
  FROM customer)
SELECT t.c_custkey, t.c_mktsegment AS old_segment, s.c_mktsegment AS new_segment
FROM customer t JOIN altered s ON s.c_custkey = t.c_custkey
WHERE t.c_name IS DISTINCT FROM s.c_name OR t.c_mktsegment IS DISTINCT FROM s.c_mktsegment
""")
def change_detect(spark, sf_dir):
    """Change detection by NULL-safe attribute compare (no 32-bit checksum)."""
    t = table(spark, sf_dir, "customer").alias("t")
    s = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        F.when(F.col("c_acctbal") < 0, F.lit("RESTRICTED")).otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment")).alias("s")
    j = t.join(s, F.col("t.c_custkey") == F.col("s.c_custkey"))
    return j.where(null_safe_changed(["c_name", "c_mktsegment"])).select(
        F.col("t.c_custkey").alias("c_custkey"), F.col("t.c_mktsegment").alias("old_segment"),
        F.col("s.c_mktsegment").alias("new_segment"))


@query("scalar_subquery", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate = (SELECT min(o_orderdate) FROM orders)
""")
def scalar_subquery(spark, sf_dir):
    """Uncorrelated scalar subquery (global MIN) in a predicate."""
    orders = table(spark, sf_dir, "orders")
    first = orders.agg(F.min("o_orderdate").alias("m")).scalar()
    return orders.where(F.col("o_orderdate") == first).select("o_orderkey", "o_custkey", "o_orderdate")


@query("top_one_latest", """
SELECT event_id, ts, user_id, event_type, value, props FROM events ORDER BY ts DESC LIMIT 1
""")
def top_one_latest(spark, sf_dir):
    """H2: top-1 by timestamp (TakeOrderedAndProject: per-partition top-1, no full sort)."""
    return table(spark, sf_dir, "events").orderBy(F.col("ts").desc()).limit(1)


@query("date_scalars", """
SELECT o_orderkey,
       CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS order_date_sk,
       CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o_orderdate) AS INTEGER) AS order_month,
       CAST(dayofyear(o_orderdate) AS INTEGER) AS day_in_year,
       CAST(day(o_orderdate) AS INTEGER) AS day_in_month,
       CAST(isodow(o_orderdate) AS INTEGER) AS day_in_week,
       dayname(o_orderdate) AS day_name,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS due_date,
       CAST(o_orderdate AS DATE) <= strptime('19970531', '%Y%m%d')::DATE AS before_cutoff
FROM orders
""")
def date_scalars(spark, sf_dir):
    """Date key, year/month, day parts (Monday = 1), day name, DATEADD,
    compact yyyyMMdd literal."""
    d = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", date_key(d).alias("order_date_sk"),
        F.year(d).alias("order_year"), F.month(d).alias("order_month"),
        F.dayofyear(d).alias("day_in_year"), F.dayofmonth(d).alias("day_in_month"),
        day_in_week(d).alias("day_in_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.date_add(d, 30).alias("due_date"),
        # compact literal: always parsed with an explicit format
        (d <= F.to_date(F.lit(CUTOFF_COMPACT), "yyyyMMdd")).alias("before_cutoff"))


@query("numeric_scalars", """
SELECT l_orderkey, l_linenumber,
       abs(l_extendedprice - 50000) AS abs_delta,
       l_orderkey % 7 AS key_mod,
       l_extendedprice / l_quantity AS unit_price,
       CAST(trunc(cbrt(l_quantity)) AS INTEGER) AS qty_cube_root,
       CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
            AS DECIMAL(18,2)) AS discount_amount,
       TRY_CAST(CAST(l_linenumber AS VARCHAR) AS INTEGER) AS line_as_int,
       TRY_CAST(l_returnflag AS INTEGER) AS flag_as_int
FROM lineitem
""")
def numeric_scalars(spark, sf_dir):
    """Abs, %, arithmetic, truncated cube root, ROUND on money, try_cast."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.abs(F.col("l_extendedprice") - 50000).alias("abs_delta"),
        (F.col("l_orderkey") % 7).alias("key_mod"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.cbrt("l_quantity").cast("int").alias("qty_cube_root"),
        money(F.round(money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)"), 2))
        .alias("discount_amount"),
        F.expr("try_cast(cast(l_linenumber AS STRING) AS INT)").alias("line_as_int"),
        F.expr("try_cast(l_returnflag AS INT)").alias("flag_as_int"))


@query("global_rank", """
SELECT o_orderkey, CAST(rank() OVER (ORDER BY o_orderdate, o_custkey) AS BIGINT) AS order_group
FROM orders
""")
def global_rank_q(spark, sf_dir):
    """Global RANK() (gaps) without a single-partition window."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    return global_rank(orders, ["o_orderdate", "o_custkey"], out="order_group").select(
        "o_orderkey", "order_group")


_LINE_ORDER = "d, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query("group_normalise", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       min(l_discount) OVER (PARTITION BY l_orderkey) AS min_discount,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS INTEGER) AS line_no,
       first_value(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS first_ship
FROM (SELECT *, CAST('0x' || substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR),
        CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
        'line')), 1, 8) AS BIGINT) AS d
      FROM lineitem)
""")
def group_normalise(spark, sf_dir):
    """MIN over group, ROW_NUMBER and FIRST_VALUE in seeded random order."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate")
    li = li.withColumn("d", md5_draw("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                     salt="line"))
    order = [c.strip() for c in _LINE_ORDER.split(",")]
    # One global row number over (order, seeded line order); the order's first
    # number, its minimum discount and its first ship date come from a single
    # partial aggregate joined back once — no per-order window task.
    li = global_rank(li, ["l_orderkey", *order], out="_g", method="row_number")
    per_order = li.groupBy("l_orderkey").agg(
        F.min("_g").alias("_g0"), F.min("l_discount").alias("min_discount"),
        F.min(F.struct(*[F.col(c) for c in order], F.col("l_shipdate").alias("_s")))._s
        .alias("first_ship"))
    li = same_key_join(li, per_order, ["l_orderkey"]).withColumn(
        "line_no", (F.col("_g") - F.col("_g0") + 1).cast("int"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "min_discount", "line_no",
                     "first_ship")

