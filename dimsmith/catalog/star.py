"""A star schema derived from the given tables.

* customer dimension (SCD 2): business key ``o_custkey``; one version per
  order day, category = priority of that day's last order (tie-break
  ``o_orderkey``); valid_to = next version's start - 1 day, open end 9999-12-31.
* product dimension (SCD 2): business key ``l_partkey``; one version per ship
  day, price = that day's last line price, category = price band.
* calendar: every day from the first order date to the last ship date.
* sales fact: one row per line item, dimension keys looked up at the order
  date (temporal join), discounted price paid.

The SQL fragments below build the same objects for the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimsmith.catalog.registry import table
from dimsmith.functions.scalars import OPEN_END, date_key, money
from dimsmith.operators.latest import latest_by
from dimsmith.operators.ordered import key_numbers
from dimsmith.operators.same_key import key_of
from dimsmith.operators.scd import DimSpec
from dimsmith.operators.sweep import sweep_join
from dimsmith.operators.temporal import temporal_join
from dimsmith.session import work_dir
from dimsmith.sources.calendar import calendar_between

# Fixed parameters of the star-schema queries.
REPORT_YEAR = 1997
AS_OF_DATE = dt.date(1997, 5, 31)
PRICE_BANDS = ((35000, "economy"), (70000, "standard"))
TOP_BAND = "premium"

CUSTOMER = DimSpec(business_keys=["customer_id"], attributes=["category"],
                   sk="customer_sk", dk="customer_dk")
PRODUCT = DimSpec(business_keys=["product_id"], attributes=["category", "price"],
                  sk="product_sk", dk="product_dk")


def _interval(within: Window, start: str = "valid_from") -> list[Column]:
    """valid_to (next start - 1 day) and is_current of daily snapshots, in a window over the key.

    A key has one row a day, so its rows are bounded by the calendar however many
    orders or lines it has: the window needs no time buckets.
    """
    nxt = F.lead(start).over(within)
    return [F.coalesce(F.date_sub(nxt, 1), F.lit(OPEN_END)).alias("valid_to"), nxt.isNull().alias("is_current")]


def customer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("valid_from"),
        "o_orderkey", F.col("o_orderpriority").alias("category"))
    return latest_by(orders, ["customer_id", "valid_from"], ["o_orderkey"]).drop("o_orderkey")


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = customer_days(spark, sf_dir)
    return days.select(*days.columns, *_interval(Window.partitionBy("customer_id").orderBy("valid_from")))


def product_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.to_date("l_shipdate").alias("valid_from"),
        "l_orderkey", "l_linenumber", money("l_extendedprice").alias("price"))
    days = latest_by(li, ["product_id", "valid_from"], ["l_orderkey", "l_linenumber", "price"])
    band = F.lit(TOP_BAND)
    for limit, name in reversed(PRICE_BANDS):
        band = F.when(F.col("price") < F.lit(limit), F.lit(name)).otherwise(band)
    return days.select("product_id", "valid_from", band.alias("category"), "price")


def with_keys(days: DataFrame, spec: DimSpec) -> DataFrame:
    """SCD 2 versions of daily snapshots (one row a key and day) with their keys:
    surrogate key in load order (key, valid_from), durable key per business key.

    The days are shuffled once, by key: the join with the keys' numbers and the
    window over the key share that exchange.
    """
    numbers = key_numbers(days, spec.business_keys, "_first", spec.dk)
    keyed = days.withColumn("_key", key_of(spec.business_keys)).join(
        numbers.select(key_of(spec.business_keys).alias("_key"), "_first", spec.dk), "_key")
    within = Window.partitionBy("_key").orderBy(spec.valid_from)
    sk = (F.col("_first") + F.row_number().over(within) - 1).cast("bigint").alias(spec.sk)
    return keyed.select(spec.dk, sk, *days.columns, *_interval(within, spec.valid_from)).select(*spec.columns())


def built_once(df: DataFrame, name: str) -> DataFrame:
    """A table that several branches read: written as parquet, so each reads its own columns."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_keys(customer_days(spark, sf_dir), CUSTOMER)


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_keys(product_days(spark, sf_dir), PRODUCT)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = table(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")).alias("d")).scalar()
    hi = table(spark, sf_dir, "lineitem").agg(F.max(F.to_date("l_shipdate")).alias("d")).scalar()
    return calendar_between(spark, lo, hi)


def sales_fact(spark: SparkSession, sf_dir: str, cust: DataFrame | None = None,
               prod: DataFrame | None = None, order_days: DataFrame | None = None,
               sweep: bool = False) -> DataFrame:
    """Temporal fact load: SK and DK of every dimension as of the order date.

    ``order_days`` (a small set of ``calendar_date`` rows, e.g. one report
    year) restricts the orders before any join — a broadcast semi-join, the
    reduction dynamic partition pruning would apply to a date-partitioned fact.
    ``sweep``: look versions up by ``sweep_join``, not by ``temporal_join``.

    Customers are looked up for the orders, before the lines join them: lines
    are shuffled for the order and for the product only.
    """
    cust = cust if cust is not None else customer_dim(spark, sf_dir)
    prod = prod if prod is not None else product_dim(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if order_days is not None:
        days = F.broadcast(order_days.select(F.col("calendar_date").alias("_day")))
        orders = orders.join(days, F.to_date("o_orderdate") == F.col("_day"), "left_semi")
    orders = orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
    c = cust.select("customer_id", "customer_sk", "customer_dk",
                    F.col("valid_from").alias("c_from"), F.col("valid_to").alias("c_to"))
    p = prod.select("product_id", "product_sk", "product_dk", "price",
                    F.col("valid_from").alias("p_from"), F.col("valid_to").alias("p_to"))
    found = ["o_orderkey", "order_date", "customer_sk", "customer_dk"]
    if sweep:
        o = sweep_join(orders, c, [("o_custkey", "customer_id")], "order_date", "c_from", "c_to").select(*found)
        lines = li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey")
        # bounds are drawn from the base tables; a line's ship date is near enough to its order's date for that
        j = sweep_join(lines, p, [("l_partkey", "product_id")], "order_date", "p_from", "p_to",
                       sample=li.select("l_partkey", F.to_date("l_shipdate").alias("order_date")))
    else:
        # Earliest and latest possible fact date, from one column of orders (not from the join).
        since = orders.agg(F.min("order_date").alias("s")).scalar()
        horizon = orders.agg(F.max("order_date").alias("h")).scalar()
        o = temporal_join(orders, c, [("o_custkey", "customer_id")], "order_date", "c_from", "c_to",
                          horizon=horizon, since=since).select(*found)
        lines = li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey")
        j = temporal_join(lines, p, [("l_partkey", "product_id")], "order_date", "p_from", "p_to",
                          horizon=horizon, since=since)
    discount = F.round(F.col("l_discount") * 100).cast("int")
    paid = F.round(F.col("price") * (F.lit(100) - discount) * F.lit(Decimal("0.01")), 2)
    return j.select(
        "customer_sk", "customer_dk", "product_sk", "product_dk",
        date_key(F.col("order_date")).alias("order_date_sk"),
        date_key(F.to_date("l_shipdate")).alias("ship_date_sk"),
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_line_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money(paid).alias("price_paid"))


# ---------------------------------------------------------------- oracle SQL
SQL_CUSTOMER_DIM = """
cust_day AS (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS valid_from,
         o_orderpriority AS category
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                                     ORDER BY o_orderkey DESC) AS rn FROM orders)
  WHERE rn = 1),
cust_ver AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS next_from
  FROM cust_day),
customer_dim AS (
  SELECT CAST(row_number() OVER (ORDER BY customer_id, valid_from) AS BIGINT) AS customer_sk,
         CAST(dense_rank() OVER (ORDER BY customer_id) AS BIGINT) AS customer_dk,
         customer_id, category, valid_from,
         COALESCE(CAST(next_from - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to,
         next_from IS NULL AS is_current
  FROM cust_ver)"""

SQL_PRODUCT_DIM = """
prod_day AS (
  SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS valid_from,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
          ORDER BY l_orderkey DESC, l_linenumber DESC,
                   CAST(l_extendedprice AS DECIMAL(18,2)) DESC) AS rn FROM lineitem)
  WHERE rn = 1),
prod_ver AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from) AS next_from
  FROM prod_day),
product_dim AS (
  SELECT CAST(row_number() OVER (ORDER BY product_id, valid_from) AS BIGINT) AS product_sk,
         CAST(dense_rank() OVER (ORDER BY product_id) AS BIGINT) AS product_dk,
         product_id,
         CASE WHEN price < 35000 THEN 'economy' WHEN price < 70000 THEN 'standard'
              ELSE 'premium' END AS category,
         price, valid_from,
         COALESCE(CAST(next_from - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to,
         next_from IS NULL AS is_current
  FROM prod_ver)"""

SQL_CALENDAR = """
calendar AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS calendar_sk,
         d AS calendar_date,
         CAST(year(d) AS INTEGER) AS calendar_year,
         CAST(month(d) AS INTEGER) AS month_in_year,
         CAST(dayofyear(d) AS INTEGER) AS day_in_year,
         CAST(day(d) AS INTEGER) AS day_in_month,
         CAST(isodow(d) AS INTEGER) AS day_in_week,
         dayname(d) AS day_name,
         CASE WHEN isodow(d) >= 6 THEN 'Y' ELSE 'N' END AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(
          (SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
          (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem),
          INTERVAL 1 DAY)) AS DATE) AS d))"""

SQL_FACT = """
fact AS (
  SELECT c.customer_sk, c.customer_dk, p.product_sk, p.product_dk,
         CAST(strftime(CAST(o.o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS order_date_sk,
         CAST(strftime(CAST(l.l_shipdate AS DATE), '%Y%m%d') AS INTEGER) AS ship_date_sk,
         l.l_orderkey AS order_id, l.l_linenumber AS order_line_id,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(ROUND(p.price * (100 - CAST(ROUND(l.l_discount * 100) AS INTEGER)) * 0.01, 2)
              AS DECIMAL(18,2)) AS price_paid
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer_dim c ON c.customer_id = o.o_custkey
   AND CAST(o.o_orderdate AS DATE) BETWEEN c.valid_from AND c.valid_to
  JOIN product_dim p ON p.product_id = l.l_partkey
   AND CAST(o.o_orderdate AS DATE) BETWEEN p.valid_from AND p.valid_to)"""


def with_ctes(*fragments: str) -> str:
    return "WITH " + ",".join(f.strip("\n") for f in fragments) + "\n"
