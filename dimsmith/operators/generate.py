"""Seeded order generator: seeds × calendar days → normalised order lines.

Seed columns: ``customer_id, product_id, qty_min, qty_max, freq_days,
excl_pct`` plus ``seed_keys`` that make each seed unique (they feed the draws).

* Days: every calendar date in [start, end) whose day-of-year is a multiple
  of ``freq_days`` (``DayInYear % freq = 0``). Instead of a theta join of
  seeds and calendar we list each seed's multiples (≤ 366 values) and
  equi-join on ``day_in_year``; a frequency above 366 yields no day.
* Draws: ``md5_draws(seed keys, date)`` — reproducible, engine-neutral.
  quantity = qty_min + draw % (qty_max - qty_min + 1); discount from a
  cube-root-skewed draw (0/10/20 %); a line is kept when draw % 100 >
  excl_pct; the order date moves 0-5 days; shipping takes 0-2 more days.
* Normalise per (date, customer) = one order: minimum discount and shipping
  delay, order id = global RANK over (date, customer), line number and date
  shift from the seeded order within the order. Lines are range-partitioned by
  (date, customer) and sorted once; windows over the order read that order, and
  the rank is the place of the order's first line plus one offset a partition.
  An order's lines are one task's: a customer's seeds once, as the days of a
  seed are different orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimsmith.functions.scalars import discount_bucket, md5_draws
from dimsmith.session import work_dir

MAX_DAY_IN_YEAR = 366


def seed_days(seeds: DataFrame, calendar: DataFrame, start, end) -> DataFrame:
    """Seeds × calendar dates with day_in_year % freq_days = 0 in [start, end)."""
    multiples = F.when(F.col("freq_days") <= MAX_DAY_IN_YEAR,
                       F.sequence(F.col("freq_days"), F.lit(MAX_DAY_IN_YEAR), F.col("freq_days"))
                       ).otherwise(F.array().cast("array<int>"))
    spread = seeds.withColumn("day_in_year", F.explode(multiples))
    cal = calendar.where((F.col("calendar_date") >= start) & (F.col("calendar_date") < end)) \
        .select("day_in_year", "calendar_date")
    return spread.join(cal, on="day_in_year").drop("day_in_year")


def generate_orders(seeds: DataFrame, calendar: DataFrame, start, end,
                    seed_keys: Sequence[str]) -> DataFrame:
    keys = list(seed_keys)
    order = ["calendar_date", "customer_id"]
    # Ranges are sampled from, and dealt as, plain seed days: the hashing is the expensive part, and
    # comes once, behind the shuffle (beside the partition's number the draws are not computed again
    # in the filter), the second hash only for the lines that stay.
    days = seed_days(seeds, calendar, start, end).repartitionByRange(*order)

    qty, disc, incl, adj, ship, line = md5_draws(*keys, "calendar_date", n=6)
    ship_v = ship % 189 + F.lit(28)
    lines = days.select(
        F.spark_partition_id().alias("_part"), "customer_id", "product_id", "calendar_date", *keys,
        (F.col("qty_min") + qty % (F.col("qty_max") - F.col("qty_min") + 1))
        .cast("int").alias("quantity"),
        discount_bucket(disc % 189).alias("discount"),
        (incl % 100 > F.col("excl_pct")).alias("include"),
        (adj % 6).cast("int").alias("date_adj"))
    lines = lines.where(F.col("include") & (F.col("quantity") > 0)).drop("include").withColumns({
        "ship_adj": F.when(ship_v <= 64, 2).when(ship_v <= 125, 1).otherwise(0), "line_draw": line})
    line_order = ["line_draw", "product_id", *keys, "date_adj"]
    ranged = lines.sortWithinPartitions(*order, *line_order).withColumn("_id", F.monotonically_increasing_id())
    of_order = Window.partitionBy(*order)
    in_order = of_order.orderBy(*line_order)
    order_date = F.date_add(F.col("calendar_date"), F.first("date_adj").over(in_order))
    numbered = ranged.withColumn("order_line_id", F.row_number().over(in_order)).withColumn("order_date", order_date).select(
        "_part", "_id", "order_line_id", "customer_id", "product_id", "quantity",
        F.min("discount").over(of_order).alias("discount"), "order_date",
        F.date_add("order_date", F.min("ship_adj").over(of_order)).alias("ship_date"))
    # Stored once: the offsets count the rows of the very partitions that were sorted.
    path = work_dir(seeds.sparkSession, "generated-orders")
    numbered.write.parquet(path)
    numbered = seeds.sparkSession.read.schema(numbered.schema).parquet(path)
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    out = numbered.join(F.broadcast(offsets), "_part").where(F.col("customer_id").isNotNull())
    return out.select((F.col("_off") + place - F.col("order_line_id") + 2).cast("bigint").alias("order_id"),
                      "order_line_id", "customer_id", "product_id", "quantity", "discount", "order_date", "ship_date")
