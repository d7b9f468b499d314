"""Expectations (warn / drop / fail / report), event log and JSON queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimsmith.catalog.registry import query, table
from dimsmith.plans.quality import Expectation, apply_expectations, quality_report

# Fixed rule sets of the quality queries.
ORDER_RULES = [
    Expectation("segment_known", "c_mktsegment IS NOT NULL", "warn"),
    Expectation("price_positive", "o_totalprice > 0", "warn"),
]
LINE_RULES = [
    Expectation("ships_after_order", "l_shipdate >= o_orderdate", "drop"),
    Expectation("discount_at_most_8pct", "l_discount <= 0.08", "drop"),
    Expectation("tax_recorded", "l_tax > 0", "warn"),
    Expectation("order_known", "o_orderkey IS NOT NULL", "fail"),
]


def _orders_customers(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "left").drop("c_custkey")


def _lines_orders(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_discount", "l_tax")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey, "left")


@query("expect_warn", """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
""")
def expect_warn(spark, sf_dir):
    """Warn rules keep every row (one on a joined column); counts observed."""
    out, _ = apply_expectations(_orders_customers(spark, sf_dir), ORDER_RULES, "orders")
    return out


@query("expect_drop", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate, l.l_discount, l.l_tax,
       o.o_orderkey, o.o_orderdate
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE COALESCE(l.l_shipdate >= o.o_orderdate, false) AND COALESCE(l.l_discount <= 0.08, false)
""")
def expect_drop(spark, sf_dir):
    """Drop + warn + fail rule set; violating rows removed, NULL = violation."""
    out, _ = apply_expectations(_lines_orders(spark, sf_dir), LINE_RULES, "lines")
    return out


@query("expect_report", """
WITH j AS (SELECT l.*, o.o_orderkey, o.o_orderdate
           FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT 'lines' AS dataset, 'ships_after_order' AS expectation,
       CAST(count_if(COALESCE(l_shipdate >= o_orderdate, false)) AS BIGINT) AS passed_records,
       CAST(count_if(NOT COALESCE(l_shipdate >= o_orderdate, false)) AS BIGINT) AS failed_records FROM j
UNION ALL
SELECT 'lines', 'discount_at_most_8pct', CAST(count_if(COALESCE(l_discount <= 0.08, false)) AS BIGINT),
       CAST(count_if(NOT COALESCE(l_discount <= 0.08, false)) AS BIGINT) FROM j
UNION ALL
SELECT 'lines', 'tax_recorded', CAST(count_if(COALESCE(l_tax > 0, false)) AS BIGINT),
       CAST(count_if(NOT COALESCE(l_tax > 0, false)) AS BIGINT) FROM j
UNION ALL
SELECT 'lines', 'order_known', CAST(count_if(o_orderkey IS NOT NULL) AS BIGINT), CAST(count_if(o_orderkey IS NULL) AS BIGINT) FROM j
""")
def expect_report(spark, sf_dir):
    """Passed / failed records per rule (one aggregate pass, passed+failed = rows)."""
    return quality_report(_lines_orders(spark, sf_dir), LINE_RULES, "lines")


@query("json_explode_sum", """
SELECT event_type,
       CAST(SUM(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total_k,
       count(*) AS n_items,
       MAX(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS max_k
FROM events GROUP BY event_type
""")
def json_explode_sum(spark, sf_dir):
    """from_json to array<struct>, explode (inline), sum; JSON path access."""
    ev = table(spark, sf_dir, "events")
    items = ev.select("event_type",
                      F.explode(F.from_json(F.concat(F.lit("["), F.col("props"), F.lit("]")),
                                            "array<struct<k: int>>")).alias("item"),
                      F.get_json_object("props", "$.k").cast("int").alias("k_path"))
    return items.groupBy("event_type").agg(
        F.sum("item.k").alias("total_k"), F.count(F.lit(1)).alias("n_items"),
        F.max("k_path").alias("max_k"))

