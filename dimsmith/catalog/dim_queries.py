"""Dimension queries: SCD 2 build, keys, merge, current view, checks, facts."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from dimsmith.catalog import star
from dimsmith.catalog.registry import ORACLE, query, table
from dimsmith.catalog.star import (CUSTOMER, SQL_CUSTOMER_DIM, SQL_FACT, SQL_PRODUCT_DIM,
                                   with_ctes)
from dimsmith.operators.latest import latest_by
from dimsmith.operators.scd import (backfill_from, current_view, duplicate_keys, null_counts,
                                    scd2_merge)
from dimsmith.operators.scd_diff import DigestedDim
from dimsmith.operators.temporal import temporal_join
from dimsmith.session import work_dir
from dimsmith.sinks.tables import create_view, save_table, table_properties

# Fixed parameters of the merge query: the existing dimension is the one built
# from orders before MERGE_BASE, the attribute snapshot is that of all orders,
# merged on MERGE_RUN (a day after the last order).
MERGE_BASE = dt.date(1998, 1, 1)
MERGE_RUN = dt.date(2010, 1, 1)


@query("customer_dim_scd2", with_ctes(SQL_CUSTOMER_DIM) + """
SELECT customer_id, category, valid_from, valid_to, is_current FROM customer_dim
""")
def customer_dim_scd2(spark, sf_dir):
    """S3 with inclusive dates: one version per order day, valid_to = next - 1 day."""
    return star.customer_versions(spark, sf_dir).select(
        "customer_id", "category", "valid_from", "valid_to", "is_current")


@query("durable_keys", with_ctes(SQL_CUSTOMER_DIM) + """
SELECT customer_id, valid_from, customer_dk FROM customer_dim
""")
def durable_keys(spark, sf_dir):
    """One durable key per business key, spread to every version."""
    from dimsmith.operators.keys import assign_durable_keys
    dim = star.customer_versions(spark, sf_dir)
    return assign_durable_keys(dim, ["customer_id"], out="customer_dk").select(
        "customer_id", "valid_from", "customer_dk")


@query("surrogate_keys", with_ctes(SQL_CUSTOMER_DIM) + """
SELECT customer_id, valid_from, customer_sk FROM customer_dim
""")
def surrogate_keys(spark, sf_dir):
    """Surrogate keys in load order (business key, valid_from)."""
    from dimsmith.operators.keys import assign_surrogate_keys
    dim = star.customer_versions(spark, sf_dir)
    return assign_surrogate_keys(dim, ["customer_id", "valid_from"], out="customer_sk").select(
        "customer_id", "valid_from", "customer_sk")


@query("current_view", with_ctes(SQL_CUSTOMER_DIM) + """
SELECT customer_dk, category AS current_category FROM customer_dim WHERE is_current
""")
def current_view_q(spark, sf_dir):
    """Current attributes by durable key."""
    return current_view(star.customer_dim(spark, sf_dir), CUSTOMER)


def _merge_inputs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    base = orders.where(F.col("o_orderdate") < F.lit(dt.datetime.combine(MERGE_BASE, dt.time())))
    return base, orders


def _merge_tables(spark, sf_dir):
    """The dimension before the merge and the attribute snapshot."""
    base, snap = _merge_inputs(spark, sf_dir)
    days = latest_by(base.select(F.col("o_custkey").alias("customer_id"),
                                 F.to_date("o_orderdate").alias("valid_from"), "o_orderkey",
                                 F.col("o_orderpriority").alias("category")),
                     ["customer_id", "valid_from"], ["o_orderkey"]).drop("o_orderkey")
    # The dimension before the merge is an existing table: materialise it once
    # (the merge reads current rows, closed rows, distinct keys and key maxima).
    dim0 = star.with_keys(days, CUSTOMER).checkpoint(eager=True)
    updates = latest_by(snap.select(F.col("o_custkey").alias("customer_id"), "o_orderdate",
                                    "o_orderkey", F.col("o_orderpriority").alias("category")),
                        ["customer_id"], ["o_orderdate", "o_orderkey"]).select(
        "customer_id", "category")
    return dim0, updates


@query("scd2_merge", f"""
WITH src0 AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{MERGE_BASE} 00:00:00'),
d0_day AS (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS valid_from,
         o_orderpriority AS category
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                                     ORDER BY o_orderkey DESC) AS rn FROM src0)
  WHERE rn = 1),
d0_ver AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS next_from
  FROM d0_day),
dim0 AS (
  SELECT CAST(row_number() OVER (ORDER BY customer_id, valid_from) AS BIGINT) AS customer_sk,
         CAST(dense_rank() OVER (ORDER BY customer_id) AS BIGINT) AS customer_dk,
         customer_id, category, valid_from,
         COALESCE(CAST(next_from - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to,
         next_from IS NULL AS is_current
  FROM d0_ver),
upd AS (
  SELECT customer_id, category FROM (
    SELECT o_custkey AS customer_id, o_orderpriority AS category,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders)
  WHERE rn = 1),
chg AS (
  SELECT c.customer_id, c.customer_dk, u.category
  FROM dim0 c JOIN upd u ON u.customer_id = c.customer_id
  WHERE c.is_current AND c.category IS DISTINCT FROM u.category),
kept AS (
  SELECT d.customer_sk, d.customer_dk, d.customer_id, d.category, d.valid_from,
         CASE WHEN chg.customer_id IS NOT NULL AND d.is_current
              THEN CAST(DATE '{MERGE_RUN}' - INTERVAL 1 DAY AS DATE) ELSE d.valid_to END AS valid_to,
         CASE WHEN chg.customer_id IS NOT NULL AND d.is_current THEN false
              ELSE d.is_current END AS is_current
  FROM dim0 d LEFT JOIN chg ON chg.customer_id = d.customer_id),
newkeys AS (
  SELECT u.customer_id, u.category FROM upd u
  WHERE NOT EXISTS (SELECT 1 FROM dim0 d WHERE d.customer_id = u.customer_id)),
mx AS (SELECT max(customer_sk) AS msk, max(customer_dk) AS mdk FROM dim0),
fresh AS (
  SELECT customer_id, category, customer_dk FROM chg
  UNION ALL
  SELECT n.customer_id, n.category,
         CAST(mx.mdk + row_number() OVER (ORDER BY n.customer_id) AS BIGINT)
  FROM newkeys n, mx)
SELECT customer_sk, customer_dk, customer_id, category, valid_from, valid_to, is_current FROM kept
UNION ALL
SELECT CAST(mx.msk + row_number() OVER (ORDER BY f.customer_id) AS BIGINT), f.customer_dk,
       f.customer_id, f.category, DATE '{MERGE_RUN}', DATE '9999-12-31', true
FROM fresh f, mx
""")
def scd2_merge_q(spark, sf_dir):
    """SCD 2 merge of an attribute snapshot into the dimension (same DK on change)."""
    dim0, updates = _merge_tables(spark, sf_dir)
    return scd2_merge(dim0, updates, CUSTOMER, MERGE_RUN)


@query("scd2_merge_diff", ORACLE["scd2_merge"])
def scd2_merge_diff(spark, sf_dir):
    """The same merge into a stored dimension with a digest per key bucket; only buckets that differ are read."""
    dim0, updates = _merge_tables(spark, sf_dir)
    dim = DigestedDim(spark, work_dir(spark, "digested-dim"), CUSTOMER, buckets=64, fanout=8)
    dim.create(dim0)
    dim.merge(updates, MERGE_RUN)
    return dim.read()


_NULL_PART = "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END"


def _nullable_orders(spark, sf_dir):
    """Orders with a key part that is NULL for a fifth of the customers."""
    return table(spark, sf_dir, "orders").select(
        F.expr(_NULL_PART).alias("customer"), F.col("o_orderpriority").alias("priority"),
        "o_orderkey", "o_orderdate")


@query("durable_keys_nulls", f"""
SELECT customer, priority, o_orderkey,
       CAST(dense_rank() OVER (ORDER BY customer NULLS FIRST, priority) AS BIGINT) AS dk
FROM (SELECT {_NULL_PART} AS customer, o_orderpriority AS priority, o_orderkey FROM orders)
""")
def durable_keys_nulls(spark, sf_dir):
    """S6 with a NULL key part: a key like any other, no row lost."""
    from dimsmith.operators.keys import assign_durable_keys
    return assign_durable_keys(_nullable_orders(spark, sf_dir).drop("o_orderdate"),
                               ["customer", "priority"])


@query("latest_version_all_nulls", f"""
SELECT customer, priority, o_orderkey, o_orderdate FROM (
  SELECT *, rank() OVER (PARTITION BY customer ORDER BY o_orderdate DESC) AS r
  FROM (SELECT {_NULL_PART} AS customer, o_orderpriority AS priority, o_orderkey, o_orderdate FROM orders))
WHERE r = 1
""")
def latest_version_all_nulls(spark, sf_dir):
    """G2 with NULL keys: every row tied at the latest date of its key."""
    return latest_by(_nullable_orders(spark, sf_dir), ["customer"], ["o_orderdate"], keep="all")


@query("global_rank_nulls", f"""
SELECT o_orderkey, customer, CAST(rank() OVER (ORDER BY customer NULLS FIRST) AS BIGINT) AS rank
FROM (SELECT {_NULL_PART} AS customer, o_orderkey FROM orders)
""")
def global_rank_nulls(spark, sf_dir):
    """G4 with NULL order values: ranked first."""
    from dimsmith.operators.ordered import global_rank
    return global_rank(_nullable_orders(spark, sf_dir).select("o_orderkey", "customer"), ["customer"])


@query("scd2_null_keys", """
SELECT customer, o_orderkey, start_at,
       lead(start_at) OVER (PARTITION BY customer ORDER BY start_at) AS end_at
FROM (SELECT CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END AS customer, o_orderkey,
             CAST(o_orderkey AS BIGINT) AS start_at FROM orders)
""")
def scd2_null_keys(spark, sf_dir):
    """S3 with NULL keys: one chain, one open version."""
    from dimsmith.operators.cdc import ChangeSpec, apply_changes
    feed = _nullable_orders(spark, sf_dir).select(
        "customer", "o_orderkey", F.col("o_orderkey").cast("bigint").alias("seq"))
    return apply_changes(feed, ChangeSpec(["customer"], "seq", 2))


def _order_fact(spark, sf_dir, cust):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), "o_custkey",
        F.to_date("o_orderdate").alias("order_date"))
    c = cust.select("customer_id", "customer_sk", F.col("valid_from").alias("c_from"),
                    F.col("valid_to").alias("c_to"))
    return temporal_join(orders, c, [("o_custkey", "customer_id")], "order_date",
                         "c_from", "c_to").select("order_id", "customer_sk")


SQL_ORDER_FACT = """
order_fact AS (
  SELECT o.o_orderkey AS order_id, c.customer_sk
  FROM orders o JOIN customer_dim c ON c.customer_id = o.o_custkey
   AND CAST(o.o_orderdate AS DATE) BETWEEN c.valid_from AND c.valid_to)"""


@query("fact_dk_backfill", with_ctes(SQL_CUSTOMER_DIM, SQL_ORDER_FACT) + """
SELECT f.order_id, f.customer_sk, c.customer_dk
FROM order_fact f LEFT JOIN customer_dim c ON c.customer_sk = f.customer_sk
""")
def fact_dk_backfill(spark, sf_dir):
    """Add the durable key to a fact through its existing surrogate key."""
    cust = star.customer_dim(spark, sf_dir)
    fact = _order_fact(spark, sf_dir, cust)
    return backfill_from(fact, cust, via="customer_sk", columns=["customer_dk"]).select(
        "order_id", "customer_sk", "customer_dk")


@query("not_null_check", with_ctes(SQL_CUSTOMER_DIM, SQL_ORDER_FACT) + """
SELECT CAST(SUM(CASE WHEN c.customer_dk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS customer_dk_nulls,
       CAST(SUM(CASE WHEN f.customer_sk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS customer_sk_nulls
FROM order_fact f LEFT JOIN customer_dim c ON c.customer_sk = f.customer_sk
""")
def not_null_check(spark, sf_dir):
    """The backfilled durable key may be promoted to NOT NULL when this is all zero."""
    cust = star.customer_dim(spark, sf_dir)
    fact = backfill_from(_order_fact(spark, sf_dir, cust), cust, "customer_sk", ["customer_dk"])
    return null_counts(fact, ["customer_dk", "customer_sk"])


@query("fact_load_temporal", with_ctes(SQL_CUSTOMER_DIM, SQL_PRODUCT_DIM, SQL_FACT) + """
SELECT * FROM fact
""")
def fact_load_temporal(spark, sf_dir):
    """SK and DK of both dimensions looked up at the order date."""
    return star.sales_fact(spark, sf_dir)


@query("fact_load_sweep", ORACLE["fact_load_temporal"])
def fact_load_sweep(spark, sf_dir):
    """E12/S14 by a sweep: facts and versions in one sorted stream, the last version carried forward."""
    cust = star.built_once(star.customer_dim(spark, sf_dir), "customer_dim")
    prod = star.built_once(star.product_dim(spark, sf_dir), "product_dim")
    return star.sales_fact(spark, sf_dir, cust, prod, sweep=True)


@query("catalog_current_view", with_ctes(SQL_CUSTOMER_DIM) + """
SELECT customer_dk, category AS current_category, 'gold' AS layer, 'customer versions; one row a member''s day' AS comment
FROM customer_dim WHERE is_current
""")
def catalog_current_view(spark, sf_dir):
    """A catalog table with comment and properties and a stored view, read by name from another session."""
    name = f"customer_{uuid.uuid4().hex[:12]}"
    save_table(star.customer_dim(spark, sf_dir), name, work_dir(spark, "catalog-table"),
               comment="customer versions; one row a member's day", properties={"layer": "gold"})
    create_view(spark, f"{name}_current", f"SELECT customer_dk, category AS current_category FROM {name} WHERE is_current",
                comment="one row a member")
    other = spark.newSession()
    told = {r["key"]: r["value"] for r in table_properties(other, name).collect()}      # some rows of one table
    return other.table(f"{name}_current").select(
        "customer_dk", "current_category", F.lit(told.get("layer")).alias("layer"), F.lit(told.get("comment")).alias("comment"))


@query("pk_check", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def pk_check(spark, sf_dir):
    """Primary-key uniqueness; rows returned are the violations."""
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("current_unique_check", with_ctes(SQL_CUSTOMER_DIM) + """
SELECT customer_dk, COUNT(*) AS n FROM customer_dim WHERE is_current
GROUP BY customer_dk HAVING COUNT(*) > 1
""")
def current_unique_check(spark, sf_dir):
    """At most one current row per durable key (empty result = holds)."""
    dim = star.customer_dim(spark, sf_dir)
    return duplicate_keys(dim, ["customer_dk"], where=F.col("is_current"))


@query("calendar_dim", with_ctes(star.SQL_CALENDAR) + """
SELECT * FROM calendar
""")
def calendar_dim(spark, sf_dir):
    """Calendar over the data's date range."""
    return star.calendar(spark, sf_dir)
