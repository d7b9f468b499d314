"""Seeded order generation (S16) and its lateral calendar expansion.

Seeds come from the data: every line of each customer's latest order is a
standing order for that customer and part — quantity range 1..(1 + qty % 4),
frequency 30 × line number days (above 366 never fires), exclusion chance
9 × discount percent. Dates run from the first order date to 7 days before
the last one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dimsmith.catalog import star
from dimsmith.catalog.registry import query, table
from dimsmith.operators.generate import generate_orders, seed_days
from dimsmith.operators.latest import latest_by

SEED_KEYS = ["seed_order", "seed_line", "seed_supp"]


def seeds(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    latest = latest_by(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount")
    j = latest.join(li, latest.o_orderkey == li.l_orderkey)
    return j.select(
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_orderkey").alias("seed_order"), F.col("l_linenumber").alias("seed_line"),
        F.col("l_suppkey").alias("seed_supp"),
        F.lit(1).alias("qty_min"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 4).alias("qty_max"),
        (F.lit(30) * F.col("l_linenumber")).alias("freq_days"),
        (F.round(F.col("l_discount") * 100).cast("int") * 9).alias("excl_pct"))


def _range(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    lo = o.agg(F.min(F.to_date("o_orderdate")).alias("d")).scalar()
    hi = o.agg(F.date_sub(F.max(F.to_date("o_orderdate")), 7).alias("d")).scalar()
    return lo, hi


SQL_SEEDS = """
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                              ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
                 FROM orders) WHERE rn = 1),
seeds AS (
  SELECT o.o_custkey AS customer_id, l.l_partkey AS product_id, l.l_orderkey AS seed_order,
         l.l_linenumber AS seed_line, l.l_suppkey AS seed_supp, 1 AS qty_min,
         1 + CAST(l.l_quantity AS INTEGER) % 4 AS qty_max, 30 * l.l_linenumber AS freq_days,
         CAST(ROUND(l.l_discount * 100) AS INTEGER) * 9 AS excl_pct
  FROM latest o JOIN lineitem l ON l.l_orderkey = o.o_orderkey),
rng AS (
  SELECT min(CAST(o_orderdate AS DATE)) AS lo,
         CAST(max(CAST(o_orderdate AS DATE)) - INTERVAL 7 DAY AS DATE) AS hi FROM orders),
days AS (
  SELECT s.*, c.calendar_date FROM seeds s, calendar c, rng
  WHERE c.day_in_year % s.freq_days = 0 AND c.calendar_date >= rng.lo AND c.calendar_date < rng.hi)"""


@query("lateral_days", star.with_ctes(star.SQL_CALENDAR, SQL_SEEDS) + """
SELECT customer_id, product_id, seed_order, seed_line, seed_supp, calendar_date FROM days
""")
def lateral_days(spark, sf_dir):
    """Correlated calendar lookup per seed (DayInYear % freq = 0)."""
    lo, hi = _range(spark, sf_dir)
    return seed_days(seeds(spark, sf_dir), star.calendar(spark, sf_dir), lo, hi).select(
        "customer_id", "product_id", *SEED_KEYS, "calendar_date")


def _draw_sql(i: int) -> str:
    g, j, half = i // 4, (i % 4) // 2, i % 2
    v = ("CAST('0x' || substr(md5(concat_ws('|', CAST(seed_order AS VARCHAR), "
         "CAST(seed_line AS VARCHAR), CAST(seed_supp AS VARCHAR), "
         f"CAST(calendar_date AS VARCHAR), 'g{g}')), {1 + 15 * j}, 15) AS BIGINT)")
    return f"({v} >> 30)" if half == 0 else f"({v} & 1073741823)"


_QTY, _DISC, _INCL, _ADJ, _SHIP, _LINE_DRAW = range(6)
_GROUP = "PARTITION BY calendar_date, customer_id"
_LINE_ORDER = "ORDER BY line_draw, product_id, seed_order, seed_line, seed_supp"

SQL_GENERATED = star.with_ctes(star.SQL_CALENDAR, SQL_SEEDS, f"""
drawn AS (
  SELECT customer_id, product_id, calendar_date, seed_order, seed_line, seed_supp,
         CAST(qty_min + {_draw_sql(_QTY)} % (qty_max - qty_min + 1) AS INTEGER) AS quantity,
         CASE WHEN {_draw_sql(_DISC)} % 189 + 28 <= 64 THEN 20
              WHEN {_draw_sql(_DISC)} % 189 + 28 <= 125 THEN 10 ELSE 0 END AS discount,
         {_draw_sql(_INCL)} % 100 > excl_pct AS include,
         CAST({_draw_sql(_ADJ)} % 6 AS INTEGER) AS date_adj,
         CASE WHEN {_draw_sql(_SHIP)} % 189 + 28 <= 64 THEN 2
              WHEN {_draw_sql(_SHIP)} % 189 + 28 <= 125 THEN 1 ELSE 0 END AS ship_adj,
         {_draw_sql(_LINE_DRAW)} AS line_draw
  FROM days),
norm AS (
  SELECT customer_id, product_id, calendar_date, quantity,
         min(discount) OVER ({_GROUP}) AS discount,
         CAST(rank() OVER (ORDER BY calendar_date, customer_id) AS BIGINT) AS order_id,
         CAST(row_number() OVER ({_GROUP} {_LINE_ORDER}) AS INTEGER) AS order_line_id,
         first_value(date_adj) OVER ({_GROUP} {_LINE_ORDER}) AS date_adj,
         min(ship_adj) OVER ({_GROUP}) AS ship_adj
  FROM drawn WHERE include AND quantity > 0)""") + """
SELECT order_id, order_line_id, customer_id, product_id, quantity, discount,
       CAST(calendar_date + INTERVAL (date_adj) DAY AS DATE) AS order_date,
       CAST(calendar_date + INTERVAL (date_adj + ship_adj) DAY AS DATE) AS ship_date
FROM norm
"""


@query("generated_orders", SQL_GENERATED)
def generated_orders(spark, sf_dir):
    """Seeded random order lines, normalised per (date, customer), dated."""
    lo, hi = _range(spark, sf_dir)
    return generate_orders(seeds(spark, sf_dir), star.calendar(spark, sf_dir), lo, hi, SEED_KEYS)
