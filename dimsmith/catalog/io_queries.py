"""Delimited-text scans, schema drift and sinks, each written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimsmith.catalog.inventory_queries import SQL_SET_PARTS, _set_parts
from dimsmith.catalog.registry import query, table
from dimsmith.operators.joins import build_inventory
from dimsmith.catalog.stream_queries import land
from dimsmith.session import work_dir
from dimsmith.sinks.files import (append, latest_snapshot, write_partitioned_csv,
                                  write_quoted_csv, write_snapshot, write_text_table)
from dimsmith.sources.files import all_string_schema, read_delimited, read_with_drift

# Fixed lookup rows: market segment -> short code (an inline VALUES table).
SEGMENT_CODES = [("AUTOMOBILE", "AU"), ("BUILDING", "BU"), ("FURNITURE", "FU"),
                 ("HOUSEHOLD", "HH"), ("MACHINERY", "MA")]


@query("csv_delimited_scan", """
WITH codes AS (SELECT * FROM (VALUES ('AUTOMOBILE', 'AU'), ('BUILDING', 'BU'),
  ('FURNITURE', 'FU'), ('HOUSEHOLD', 'HH'), ('MACHINERY', 'MA')) AS v(segment, code))
SELECT c.c_custkey,
       c.c_name || ', "' || c.c_mktsegment || '" \\ ' || CAST(c.c_nationkey AS VARCHAR) AS label,
       CAST(c.c_acctbal AS DECIMAL(18,2)) AS acctbal, codes.code AS segment_code
FROM customer c LEFT JOIN codes ON codes.segment = c.c_mktsegment
""")
def csv_delimited_scan(spark, sf_dir):
    """A3/A4/A5/A10: quoted + escaped delimited text written, read back with a
    declared all-string schema, cast, joined to an inline VALUES lookup."""
    wd = work_dir(spark, "csvscan")
    cust = table(spark, sf_dir, "customer")
    labelled = cust.select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('" \\ '),
                 F.col("c_nationkey").cast("string")).alias("label"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("acctbal"),
        "c_mktsegment")
    write_quoted_csv(labelled, f"{wd}/customer_csv")
    back = read_delimited(spark, f"{wd}/customer_csv",
                          schema=all_string_schema(labelled.columns),
                          options={"sep": ",", "header": True, "quote": '"', "escape": "\\"})
    codes = spark.createDataFrame(SEGMENT_CODES, "segment string, code string")
    typed = back.select(
        F.expr("try_cast(c_custkey AS BIGINT)").alias("c_custkey"), "label",
        F.expr("try_cast(acctbal AS DECIMAL(18,2))").alias("acctbal"), "c_mktsegment")
    return typed.join(F.broadcast(codes), typed.c_mktsegment == codes.segment, "left").select(
        "c_custkey", "label", "acctbal", F.col("code").alias("segment_code"))


@query("schema_drift", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
            THEN 'p' || CAST(o_orderkey % 3 AS VARCHAR) END AS o_comment
FROM orders
""")
def schema_drift(spark, sf_dir):
    """Files of one folder with different headers, later ones with another
    column order and an extra column; declared columns cast, the new one kept as
    string, earlier files get NULL for it."""
    wd = work_dir(spark, "drift")
    orders = table(spark, sf_dir, "orders")
    late = F.col("o_orderdate") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    opts = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    land(orders.where(~late), f"{wd}/drops", fmt="csv", **opts)
    extra = F.concat(F.lit("p"), (F.col("o_orderkey") % 3).cast("string")).alias("o_comment")
    land(orders.where(late).select(extra, *reversed(orders.columns)), f"{wd}/drops", fmt="csv", **opts)
    declared = {f.name: f.dataType.simpleString() for f in orders.schema.fields}
    return read_with_drift(spark, [f"{wd}/drops"], declared, options={"header": True})


@query("sink_partitioned_csv", """
SELECT p_partkey, p_name, p_brand, p_size FROM part
""")
def sink_partitioned_csv(spark, sf_dir):
    """Hive-partitioned CSV, rows co-located by the partition key first."""
    wd = work_dir(spark, "partcsv")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    write_partitioned_csv(part, f"{wd}/parts", "p_size")
    back = read_delimited(spark, f"{wd}/parts", options={"header": True, "inferSchema": True})
    return back.select(F.col("p_partkey").cast("bigint"), "p_name", "p_brand",
                       F.col("p_size").cast("int"))


@query("sink_quoted_csv", """
SELECT n_nationkey, n_name, n_regionkey FROM nation
""")
def sink_quoted_csv(spark, sf_dir):
    """Truncate-and-load quoted text (fixed file count) and a plain
    comma-delimited text table, both read back."""
    wd = work_dir(spark, "quotedcsv")
    nation = table(spark, sf_dir, "nation")
    write_quoted_csv(nation, f"{wd}/nation_quoted", n_files=1)
    write_text_table(nation, f"{wd}/nation_text")
    schema = "n_nationkey int, n_name string, n_regionkey int"
    quoted = read_delimited(spark, f"{wd}/nation_quoted", schema=schema,
                            options={"header": True})
    plain = read_delimited(spark, f"{wd}/nation_text", schema=schema, options={"header": False})
    # Both copies must agree row for row: keep the quoted copy's rows present in both.
    return quoted.join(plain, on=["n_nationkey", "n_name", "n_regionkey"], how="left_semi")


@query("sink_snapshot", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def sink_snapshot(spark, sf_dir):
    """Append loads into a table folder, then a full-refresh snapshot
    (new version, never the folder being read) read back at its latest."""
    wd = work_dir(spark, "snapshot")
    cust = table(spark, sf_dir, "customer")
    append(cust.where(F.col("c_acctbal") >= 0), f"{wd}/appended")
    append(cust.where(~(F.col("c_acctbal") >= 0)), f"{wd}/appended")
    loaded = spark.read.parquet(f"{wd}/appended")
    write_snapshot(loaded.where(F.col("c_nationkey") < 0), f"{wd}/snap")  # v=0: empty
    write_snapshot(loaded, f"{wd}/snap")                                   # v=1: full
    return latest_snapshot(spark, f"{wd}/snap")


@query("inventory_sinks", """
WITH sp AS (""" + SQL_SET_PARTS + """)
SELECT part_num, color_id, SUM(quantity) AS quantity,
       SUM(CASE WHEN is_spare = 't' THEN quantity ELSE 0 END) AS spare_quantity
FROM sp GROUP BY part_num, color_id
""")
def inventory_sinks(spark, sf_dir):
    """One persisted set-parts result feeds a text table and
    colour-partitioned part totals; the totals are read back."""
    wd = work_dir(spark, "inventory")
    _, totals_path = build_inventory(_set_parts(spark, sf_dir), wd, "part_num", "color_id",
                                     "quantity", "is_spare")
    # the partition column comes back from the folder names
    back = spark.read.options(header="true").schema(
        "part_num bigint, quantity double, spare_quantity double, color_id bigint").csv(totals_path)
    return back.select("part_num", "color_id", "quantity", "spare_quantity")
