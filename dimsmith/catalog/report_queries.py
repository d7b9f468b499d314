"""As-posted / as-is / as-of sales reports (S15) and rollup totals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dimsmith.catalog import star
from dimsmith.catalog.registry import query, table
from dimsmith.catalog.star import (AS_OF_DATE, REPORT_YEAR, SQL_CALENDAR, SQL_CUSTOMER_DIM,
                                   SQL_FACT, SQL_PRODUCT_DIM, with_ctes)
from dimsmith.functions.scalars import money
from dimsmith.operators.reports import rollup_with_totals
from dimsmith.operators.temporal import as_of

_BASE = with_ctes(SQL_CUSTOMER_DIM, SQL_PRODUCT_DIM, SQL_CALENDAR, SQL_FACT)


def _report_sql(joins: str, cust: str, prod: str) -> str:
    return _BASE + f"""
SELECT CASE WHEN GROUPING({cust}) = 1 THEN 'Total' ELSE {cust} END AS customer_category,
       CASE WHEN GROUPING({prod}) = 1 THEN 'Total' ELSE {prod} END AS product_category,
       CAST(SUM(s.quantity * s.price_paid) AS DECIMAL(18,2)) AS sales_total,
       CAST(SUM(s.quantity * (ph.price - s.price_paid)) AS DECIMAL(18,2)) AS discount_total
FROM fact s
JOIN calendar od ON od.calendar_sk = s.order_date_sk
JOIN product_dim ph ON ph.product_sk = s.product_sk
{joins}
WHERE od.calendar_year = {REPORT_YEAR}
GROUP BY ROLLUP ({cust}, {prod})
ORDER BY GROUPING({cust}), {cust}, GROUPING({prod}), {prod}
"""


_D = f"DATE '{AS_OF_DATE}'"
SQL = {
    "report_as_posted": _report_sql(
        "JOIN customer_dim ch ON ch.customer_sk = s.customer_sk", "ch.category", "ph.category"),
    "report_as_is_bk": _report_sql(
        """JOIN product_dim pc ON pc.product_id = ph.product_id AND pc.is_current
JOIN customer_dim ch ON ch.customer_sk = s.customer_sk
JOIN customer_dim cc ON cc.customer_id = ch.customer_id AND cc.is_current""",
        "cc.category", "pc.category"),
    "report_as_is_dk": _report_sql(
        """JOIN product_dim pc ON pc.product_dk = s.product_dk AND pc.is_current
JOIN customer_dim cc ON cc.customer_dk = s.customer_dk AND cc.is_current""",
        "cc.category", "pc.category"),
    "report_as_of_bk": _report_sql(
        f"""JOIN product_dim pc ON pc.product_id = ph.product_id
 AND {_D} BETWEEN pc.valid_from AND pc.valid_to
JOIN customer_dim ch ON ch.customer_sk = s.customer_sk
JOIN customer_dim cc ON cc.customer_id = ch.customer_id
 AND {_D} BETWEEN cc.valid_from AND cc.valid_to""",
        "cc.category", "pc.category"),
    "report_as_of_dk": _report_sql(
        f"""JOIN product_dim pc ON pc.product_dk = s.product_dk
 AND {_D} BETWEEN pc.valid_from AND pc.valid_to
JOIN customer_dim cc ON cc.customer_dk = s.customer_dk
 AND {_D} BETWEEN cc.valid_from AND cc.valid_to""",
        "cc.category", "pc.category"),
}


def sales_report(spark, sf_dir, mode: str):
    """mode: as_posted | as_is_bk | as_is_dk | as_of_bk | as_of_dk."""
    cust = star.built_once(star.customer_dim(spark, sf_dir), "customer_dim")
    prod = star.built_once(star.product_dim(spark, sf_dir), "product_dim")
    # One report year of the calendar: at most 366 rows, safe to broadcast.
    year = star.calendar(spark, sf_dir).where(F.col("calendar_year") == REPORT_YEAR)
    fact = star.sales_fact(spark, sf_dir, cust, prod, order_days=year)
    s = fact.join(F.broadcast(year.select("calendar_sk")),
                  fact.order_date_sk == year.calendar_sk).drop("calendar_sk")
    # the year's facts refer to versions that were alive in it: only these are joined by surrogate key
    def alive(dim):
        return dim.where((F.col("valid_from") <= F.lit(dt.date(REPORT_YEAR, 12, 31)))
                         & (F.col("valid_to") >= F.lit(dt.date(REPORT_YEAR, 1, 1))))
    ph = alive(prod).select("product_sk", "product_id", F.col("price").alias("ph_price"),
                            F.col("category").alias("ph_category"))
    s = s.join(ph, "product_sk")

    if mode == "as_posted":
        ch = alive(cust).select("customer_sk", F.col("category").alias("cc_category"))
        s = s.join(ch, "customer_sk").withColumn("pc_category", F.col("ph_category"))
    elif mode in ("as_is_bk", "as_of_bk"):
        pick = (lambda d: d.where("is_current")) if mode == "as_is_bk" else (
            lambda d: as_of(d, AS_OF_DATE))
        ch = alive(cust).select("customer_sk", "customer_id")
        cc = pick(cust).select("customer_id", F.col("category").alias("cc_category"))
        pc = pick(prod).select("product_id", F.col("category").alias("pc_category"))
        s = s.join(ch, "customer_sk").join(cc, "customer_id").join(pc, "product_id")
    elif mode in ("as_is_dk", "as_of_dk"):
        pick = (lambda d: d.where("is_current")) if mode == "as_is_dk" else (
            lambda d: as_of(d, AS_OF_DATE))
        cc = pick(cust).select("customer_dk", F.col("category").alias("cc_category"))
        pc = pick(prod).select("product_dk", F.col("category").alias("pc_category"))
        s = s.join(cc, "customer_dk").join(pc, "product_dk")
    else:
        raise ValueError(mode)

    return rollup_with_totals(
        s, [("cc_category", "customer_category"), ("pc_category", "product_category")],
        [money(F.sum(F.col("quantity") * F.col("price_paid"))).alias("sales_total"),
         money(F.sum(F.col("quantity") * (F.col("ph_price") - F.col("price_paid"))))
         .alias("discount_total")])


def _register(mode):
    name = f"report_{mode}"

    def build(spark, sf_dir):
        return sales_report(spark, sf_dir, mode)
    build.__name__ = name
    build.__doc__ = f"S15 sales report, {mode.replace('_', ' ')}."
    query(name, SQL[name])(build)


for _mode in ("as_posted", "as_is_bk", "as_is_dk", "as_of_bk", "as_of_dk"):
    _register(_mode)


@query("rollup_totals", """
SELECT CASE WHEN GROUPING(n.n_name) = 1 THEN 'Total' ELSE n.n_name END AS nation,
       CASE WHEN GROUPING(c.c_mktsegment) = 1 THEN 'Total' ELSE c.c_mktsegment END AS segment,
       CAST(SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_acctbal,
       COUNT(*) AS customers
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY ROLLUP (n.n_name, c.c_mktsegment)
ORDER BY GROUPING(n.n_name), n.n_name, GROUPING(c.c_mktsegment), c.c_mktsegment
""")
def rollup_totals(spark, sf_dir):
    """Rollup with 'Total' labels from grouping(), totals sorted last."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    j = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    return rollup_with_totals(
        j, [("n_name", "nation"), ("c_mktsegment", "segment")],
        [money(F.sum(money("c_acctbal"))).alias("total_acctbal"),
         F.count(F.lit(1)).alias("customers")])
