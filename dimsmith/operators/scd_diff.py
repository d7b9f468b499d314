"""SCD 2 merges that read only the parts of a dimension that differ from the source.

A dimension is stored in ``buckets`` parts by a hash of its business key, with a
tree of digests beside it: a leaf digests the current rows (key and attributes)
of one bucket, an inner node its children. A merge digests the attribute
snapshot in the same way, walks both trees from the root along nodes that differ,
and joins only the buckets at whose leaves they do; rows inside such a bucket
are compared column by column. Buckets without a change are neither read nor
written again.

A digest is the row count and two 64-bit combinations of row hashes, so a change
is overlooked with a chance of about 2^-128 a bucket; ``verify`` compares the
columns of the buckets with equal digests too (a full comparison, for audits).
A key that the source no longer has makes its bucket differ: it is read, and
nothing changes.

The data is plain Parquet, partitioned by bucket. A merge writes the leaves of the
changed buckets as open (no digest equals theirs, the largest keys are the new
ones), replaces the partitions by Spark's dynamic partition overwrite and then
writes their leaves as they are. After a merge that died on the way the open
buckets count as different, so the next one, of the same snapshot or another,
compares their rows and gives no key twice. One writer at a time; readers read
after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.operators.same_key import same_key_join
from dimsmith.operators.scd import DimSpec, scd2_merge
from dimsmith.session import work_dir
from dimsmith.sinks.files import latest_snapshot, write_snapshot

BUCKET = "_bucket"
LANES = (11, 23)        # seeds of the two row hashes
_DIGEST = ["node", "n", "d1", "d2"]


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """Hash of a row; a NULL is told apart from an absent value, so (NULL, x) and (x, NULL) differ."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(_row_hash(keys, 5), F.lit(buckets)).cast("int")


def leaf_digests(rows: DataFrame, spec: DimSpec) -> DataFrame:
    """(node, n, d1, d2) by bucket, of rows with a bucket column."""
    columns = [*spec.business_keys, *spec.attributes]
    return rows.groupBy(F.col(BUCKET).cast("long").alias("node")).agg(
        F.count("*").alias("n"), *[F.bit_xor(_row_hash(columns, seed)).alias(f"d{i}") for i, seed in enumerate(LANES, 1)])


def digest_tree(leaves: DataFrame, buckets: int, fanout: int) -> DataFrame:
    """(level, node, n, d1, d2): level 0 are the leaves (a row a bucket), the last one is the root."""
    levels, width = [leaves.select(*_DIGEST).withColumn("level", F.lit(0))], buckets
    while width > 1:
        width = -(-width // fanout)
        levels.append(levels[-1].groupBy(F.floor(F.col("node") / fanout).alias("node")).agg(
            F.sum("n").alias("n"), *[F.bit_xor(F.xxhash64(F.lit(seed), "node", "n", "d1", "d2")).alias(f"d{i}")
                                     for i, seed in enumerate(LANES, 1)]).withColumn("level", F.lit(len(levels))))
    return reduce(DataFrame.unionByName, levels).select("level", *_DIGEST)


def differing_leaves(new: DataFrame, old: DataFrame, levels: int, fanout: int) -> DataFrame:
    """Nodes of level 0 of ``new`` that ``old`` lacks or has with another digest, found from the root down."""
    differ = None
    for level in range(levels - 1, -1, -1):
        nodes = new.where(F.col("level") == level).select(*_DIGEST)
        if differ is not None:
            parents = differ.select(F.col("node").alias("_parent"))
            nodes = nodes.join(parents, F.floor(F.col("node") / fanout) == F.col("_parent"), "left_semi")
        differ = nodes.join(old.where(F.col("level") == level).select(*_DIGEST), _DIGEST, "left_anti")
    return differ.select("node")


class DigestedDim:
    """A dimension at ``path`` in hash buckets with a digest tree."""

    def __init__(self, spark: SparkSession, path: str, spec: DimSpec, buckets: int = 256, fanout: int = 16):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.buckets, self.fanout = buckets, fanout
        self.levels, width = 1, buckets
        while width > 1:
            width, self.levels = -(-width // fanout), self.levels + 1

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    def _write(self, rows: DataFrame) -> None:
        # the rows of a bucket meet in few files; adaptive execution splits a large bucket
        (rows.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(self.data))

    def create(self, dim: DataFrame) -> None:
        rows = dim.select(*self.spec.columns()).withColumn(BUCKET, key_bucket(self.spec.business_keys, self.buckets))
        self._write(rows)
        self._commit(self._read())

    def _commit(self, rows: DataFrame, replaced: Sequence[int] | None = None, is_open: bool = False) -> None:
        """Write the next leaves: those of ``rows`` (``is_open``: with a digest that nothing equals), and the others as they were."""
        keys = rows.groupBy(F.col(BUCKET).cast("long").alias("node")).agg(
            F.max(self.spec.sk).alias("sk"), F.max(self.spec.dk).alias("dk"))
        if is_open:
            leaves = keys.select("node", *[F.lit(v).cast("long").alias(c) for c, v in (("n", -1), ("d1", 0), ("d2", 0))], "sk", "dk")
        else:
            current = rows.where(F.coalesce(F.col(self.spec.is_current), F.lit(False)))
            leaves = keys.join(leaf_digests(current, self.spec), "node", "left").select(*_DIGEST, "sk", "dk")
        if replaced is not None:
            leaves = self._leaves().where(~F.col("node").isin(list(replaced))).unionByName(leaves)
        write_snapshot(leaves.coalesce(1), f"{self.path}/leaves")

    def _leaves(self) -> DataFrame:
        """A row a bucket: the digest of its current rows and its largest keys."""
        return latest_snapshot(self.spark, f"{self.path}/leaves")

    def _read(self, only: Sequence[int] | None = None) -> DataFrame:
        rows = self.spark.read.parquet(self.data)
        if only is not None:        # partition pruning: other buckets' files are not opened
            rows = rows.where(F.col(BUCKET).isin(list(only)))
        return rows

    def read(self) -> DataFrame:
        return self._read().select(*self.spec.columns())

    def _source(self, updates: DataFrame) -> DataFrame:
        """The attribute snapshot in the dimension's types, with buckets; written once, read by digest and merge."""
        types = {f.name: f.dataType for f in self._read().schema.fields}
        columns = [*self.spec.business_keys, *self.spec.attributes]
        rows = updates.select(*[F.col(c).cast(types[c]).alias(c) for c in columns])
        path = work_dir(self.spark, "scd-source")
        rows.withColumn(BUCKET, key_bucket(self.spec.business_keys, self.buckets)).write.parquet(path)
        return self.spark.read.parquet(path)

    def changed(self, source: DataFrame, verify: bool = False) -> list[int]:
        """Buckets (``self.buckets`` at most) in which the source differs from the current rows."""
        new = digest_tree(leaf_digests(source, self.spec), self.buckets, self.fanout)
        old = digest_tree(self._leaves().where("n IS NOT NULL"), self.buckets, self.fanout)
        out = {r.node for r in differing_leaves(new, old, self.levels, self.fanout).collect()}
        if verify:
            keys, attrs = self.spec.business_keys, self.spec.attributes
            current = self._read().where(F.col(self.spec.is_current)).select(*keys, *[F.col(a).alias(f"_d_{a}") for a in attrs],
                                                                             F.lit(True).alias("_known"))
            both = same_key_join(source.where(~F.col(BUCKET).isin(sorted(out))), current, keys, "left")
            differs = reduce(lambda x, a: x | ~F.col(a).eqNullSafe(F.col(f"_d_{a}")), attrs, F.col("_known").isNull())
            out |= {r[0] for r in both.where(differs).select(BUCKET).distinct().collect()}
        return sorted(out)

    def merge(self, updates: DataFrame, run_date: dt.date | str, verify: bool = False, **options) -> list[int]:
        """``scd2_merge`` of the buckets that differ; returns them."""
        source = self._source(updates)
        changed = self.changed(source, verify)
        if changed:
            last = self._leaves().agg(F.max("sk").alias("sk"), F.max("dk").alias("dk")).first()
            part = scd2_merge(self._read(changed).drop(BUCKET), source.where(F.col(BUCKET).isin(changed)).drop(BUCKET),
                              self.spec, run_date, last_keys=(last.sk or 0, last.dk or 0), **options)
            path = work_dir(self.spark, "scd-merged")       # whole before any partition is replaced
            part.withColumn(BUCKET, key_bucket(self.spec.business_keys, self.buckets)).write.parquet(path)
            merged = self.spark.read.parquet(path)
            self._commit(merged, changed, is_open=True)
            self._write(merged)
            self._commit(merged, changed)
        return changed
