"""Writers.

Snapshots: a full-refresh table is a folder of versions ``v=<n>``; a version
is complete when Spark's ``_SUCCESS`` marker exists. Readers take the newest
complete version, writers write the next one — never the folder being read —
so a failed or re-run job never leaves a half-written table behind, and a
replayed version number is skipped (idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and st.isDirectory():
            marker = jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
            if fs.exists(marker):
                out.append(int(name[2:]))
    return sorted(out)


def latest_snapshot_path(spark: SparkSession, root: str) -> str | None:
    v = snapshot_versions(spark, root)
    return f"{root.rstrip('/')}/v={v[-1]}" if v else None


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    path = latest_snapshot_path(spark, root)
    return spark.read.parquet(path) if path else None


def write_snapshot(df: DataFrame, root: str, version: int | None = None) -> str:
    """Write ``df`` as version ``version`` (default: newest + 1); skip if committed."""
    spark = df.sparkSession
    have = snapshot_versions(spark, root)
    v = (have[-1] + 1 if have else 0) if version is None else version
    path = f"{root.rstrip('/')}/v={v}"
    if v in have:
        return path
    df.write.mode("overwrite").parquet(path)
    return path


def drop_snapshots(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` versions; how many went."""
    gone = snapshot_versions(spark, root)[:-keep]
    for v in gone:
        fs, p, _ = _fs(spark, f"{root.rstrip('/')}/v={v}")
        fs.delete(p, True)
    return len(gone)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """INSERT … SELECT: append rows to a table folder."""
    df.write.mode("append").format(fmt).save(path)


def write_text_table(df: DataFrame, path: str) -> None:
    """Drop + create an external comma-delimited text table (no header).
    Values are quoted where needed so embedded commas survive a read back."""
    df.write.mode("overwrite").option("header", "false").csv(path)


def write_partitioned_csv(df: DataFrame, path: str, partition_col: str,
                          header: bool = True) -> None:
    """Hive-partitioned CSV. Rows are rebalanced by the partition column: rows of
    a value meet in few tasks (few files), and adaptive execution splits a value
    that is too large for one. A folder a value costs more than its bytes, so small
    shuffle partitions are not merged by size: the folders are dealt over at least
    ``spark.sql.shuffle.partitions`` tasks and two for each core."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        (df.hint("rebalance", tasks, F.col(partition_col)).write.mode("overwrite")
         .partitionBy(partition_col).option("header", str(header).lower()).csv(path))
    finally:
        spark.conf.set(key, before)


def move_single_file(spark: SparkSession, folder: str, target: str) -> str:
    """Give the only data file of a written folder a place and name of its own."""
    fs, p, jvm = _fs(spark, folder)
    parts = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise ValueError(f"{folder} has {len(parts)} data files, not one")
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(path.getParent())
    if not fs.rename(parts[0], path):
        raise RuntimeError(f"{parts[0]} could not be renamed to {target}")
    return target


def move_folder(spark: SparkSession, folder: str, target: str) -> str:
    """Give a written folder its place in one rename (as checkpoints need it of
    their file system), so that a running stream sees all its files or none."""
    fs, p, jvm = _fs(spark, folder)
    path = jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(path):
        raise FileExistsError(target)
    fs.mkdirs(path.getParent())
    if not fs.rename(p, path):
        raise RuntimeError(f"{folder} could not be renamed to {target}")
    return target


def write_quoted_csv(df: DataFrame, path: str, n_files: int | None = None,
                     header: bool = True) -> None:
    """Truncate-and-load delimited text with every value quoted. ``n_files``
    fixes the number of output files (a single file funnels the whole table
    through one task: use it only for small outputs)."""
    out = df.repartition(n_files) if n_files else df
    (out.write.mode("overwrite").option("quoteAll", "true")
     .option("header", str(header).lower()).option("escape", "\\").csv(path))
