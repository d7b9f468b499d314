"""Tables and views in the session's catalog.

``save_table`` stores a DataFrame as an external table at a path (the folder
stays when the table is dropped) with partitioning, bucketing, a comment and
properties, which any session of the same catalog reads by name.
``create_view`` stores a view: its SQL text lives in the catalog, not in the
session that made it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(table: str) -> str:
    return ".".join(f"`{p}`" for p in table.split("."))


def save_table(df: DataFrame, table: str, path: str, partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (),
               buckets: int = 0, comment: str | None = None, properties: Mapping[str, str] | None = None,
               mode: str = "errorifexists") -> DataFrame:
    """Store ``df`` as ``table`` (external, Parquet, at ``path``) and read it back."""
    spark = df.sparkSession
    writer = df.write.format("parquet").mode(mode).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(table)
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {_name(table)} IS {_text(comment)}")
    if properties:
        pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {_name(table)} SET TBLPROPERTIES ({pairs})")
    return spark.table(table)


def create_view(spark: SparkSession, view: str, sql: str, comment: str | None = None) -> DataFrame:
    """A stored view over catalog tables."""
    said = f" COMMENT {_text(comment)}" if comment is not None else ""
    spark.sql(f"CREATE OR REPLACE VIEW {_name(view)}{said} AS {sql}")
    return spark.table(view)


def table_properties(spark: SparkSession, table: str) -> DataFrame:
    """(key, value): the comment, location and properties of a table, as the catalog has them."""
    own = spark.sql(f"SHOW TBLPROPERTIES {_name(table)}")
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {_name(table)}").where(F.col("col_name").isin("Comment", "Location", "Type"))
    return own.select("key", "value").unionByName(told.select(F.lower("col_name").alias("key"), F.col("data_type").alias("value")))
