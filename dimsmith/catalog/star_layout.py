"""The star stored for reports: catalog tables, fact by year and bucketed by surrogate key.

The fact is written once, partitioned by order year and bucketed and sorted by
the product's surrogate key; the product dimension is bucketed and sorted the
same way, the customer dimension by its own key. A report then

* reads only the years of its calendar days: the days are filtered by any
  calendar condition, and the partitions they need are found at run time
  (dynamic partition pruning);
* joins fact and product bucket by bucket, without an exchange on the fact;
* sums by (customer version, product category) before the fact's customers are
  looked up, so that join moves sums, not sales.

Tables are external, in the shared folder, under names of their own; the session
catalog keeps their bucketing, comment and properties.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.catalog import star
from dimsmith.catalog.registry import query, table
from dimsmith.catalog.report_queries import SQL
from dimsmith.functions.scalars import money
from dimsmith.operators.reports import rollup_with_totals
from dimsmith.session import work_dir
from dimsmith.sinks.tables import save_table


@dataclass
class StoredStar:
    """Names of the stored tables."""
    fact: str
    product: str
    customer: str
    calendar: str


LEAST_BUCKETS, LINES_A_BUCKET = 8, 4_000_000


def store_star(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> StoredStar:
    """Build the star and store it; ``buckets``: by default their number follows the lines, so that
    the report's joins have as many tasks as the data needs and a bucket fits one."""
    if buckets is None:
        buckets = max(LEAST_BUCKETS, -(-table(spark, sf_dir, "lineitem").count() // LINES_A_BUCKET))
    tag, root = uuid.uuid4().hex[:12], work_dir(spark, "star")
    names = StoredStar(*[f"star_{n}_{tag}" for n in ("fact", "product", "customer", "calendar")])
    save_table(star.customer_dim(spark, sf_dir), names.customer, f"{root}/customer", bucket_by=["customer_sk"],
               buckets=buckets, comment="customer versions")
    save_table(star.product_dim(spark, sf_dir), names.product, f"{root}/product", bucket_by=["product_sk"],
               buckets=buckets, comment="product versions")
    save_table(star.calendar(spark, sf_dir), names.calendar, f"{root}/calendar", comment="days")
    fact = star.sales_fact(spark, sf_dir, spark.table(names.customer), spark.table(names.product))
    fact = fact.withColumn("order_year", F.floor(F.col("order_date_sk") / 10000).cast("int"))
    # one task a (year, bucket), so that a bucket is one file a year
    fact = fact.repartition("order_year", F.pmod(F.hash("product_sk"), F.lit(buckets)))
    save_table(fact, names.fact, f"{root}/fact", partition_by=["order_year"], bucket_by=["product_sk"], buckets=buckets,
               comment="sales, one row a line")
    return names


def posted_sales(spark: SparkSession, names: StoredStar, days: Column) -> DataFrame:
    """Sums by customer version and product category, of the sales of the days."""
    when = spark.table(names.calendar).where(days).select("calendar_sk", "calendar_year")
    fact = spark.table(names.fact)
    # the year is in the join so that the days prune partitions; a calendar has a row a day
    sold = fact.join(F.broadcast(when), (fact.order_year == when.calendar_year) & (fact.order_date_sk == when.calendar_sk))
    product = spark.table(names.product).select("product_sk", F.col("category").alias("pc_category"), F.col("price").alias("ph_price"))
    return sold.join(product, "product_sk").groupBy("customer_sk", "pc_category").agg(
        F.sum(F.col("quantity") * F.col("price_paid")).alias("sales"),
        F.sum(F.col("quantity") * (F.col("ph_price") - F.col("price_paid"))).alias("discount"))


def report_as_posted(spark: SparkSession, names: StoredStar, days: Column) -> DataFrame:
    customer = spark.table(names.customer).select("customer_sk", F.col("category").alias("cc_category"))
    s = posted_sales(spark, names, days).join(customer, "customer_sk")
    return rollup_with_totals(
        s, [("cc_category", "customer_category"), ("pc_category", "product_category")],
        [money(F.sum("sales")).alias("sales_total"), money(F.sum("discount")).alias("discount_total")])


@query("report_as_posted_layout", SQL["report_as_posted"])
def report_as_posted_layout(spark, sf_dir):
    """E7/S14/S15 over the stored star: pruned to the report's days at run time, fact and product joined by bucket."""
    year = F.col("calendar_date").between(f"{star.REPORT_YEAR}-01-01", f"{star.REPORT_YEAR}-12-31")
    return report_as_posted(spark, store_star(spark, sf_dir), year)
