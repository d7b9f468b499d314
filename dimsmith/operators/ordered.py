"""Order-dependent operators that stay balanced when one key is huge.

``next_within_key`` — value of the following row per key (SQL ``lead``).
    A plain ``lead() over (partition by key order by seq)`` sends every row of a
    key to one task; a key holding a third of the data becomes one straggler.
    We window over (key, time bucket of seq) instead, so a hot key is spread
    over many tasks, then fix the last row of every bucket with the first row
    of the key's next non-empty bucket. The fix table has one row per
    (key, bucket) and joins on the window's own partitioning, so the whole
    operator moves the data through exactly one full shuffle.

``global_rank`` — ``rank``/``dense_rank``/``row_number`` over a global order.
    A window with no PARTITION BY runs in one task. We count rows per
    distinct order value (partial aggregation absorbs ties), range-partition
    and sort the distinct values, stamp each with its partition and place and
    checkpoint them so every branch sees the *same* sampled bounds; the number
    is the place plus one offset per partition (one small row each, broadcast).
    NULLs are values like any other, first in ascending order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimsmith.operators.same_key import key_of, same_key_join
from dimsmith.session import ensure_checkpoint_dir

# Width of a sequence bucket when the sequence is numeric and a time unit was
# given (e.g. the default 'day'): 2^20 sequence values per bucket.
DEFAULT_NUMERIC_BUCKET = float(1 << 20)
_TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)
_NUM_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
              T.FloatType, T.DoubleType, T.DecimalType)


def bucket_of(df: DataFrame, seq: str, unit: str | float | None) -> Column:
    """Coarse, order-preserving bucket of a sequence column.

    Time columns: ``date_trunc(unit, seq)``; numeric columns: ``floor(seq / unit)``
    (a time unit on a numeric column means ``DEFAULT_NUMERIC_BUCKET``).
    ``None`` puts every row of a key in one bucket (plain window).
    """
    if unit is None:
        return F.lit(0)
    dtype = df.schema[seq].dataType
    if isinstance(dtype, _TIME_TYPES):
        return F.date_trunc(str(unit), F.col(seq))
    if isinstance(dtype, _NUM_TYPES):
        width = DEFAULT_NUMERIC_BUCKET if isinstance(unit, str) else float(unit)
        return F.floor(F.col(seq) / F.lit(width))
    raise TypeError(f"cannot bucket sequence column {seq} of type {dtype}")


def next_within_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    payload: Sequence[str] = (), prefix: str = "next_",
                    bucket_unit: str | float | None = "day") -> DataFrame:
    """Add ``prefix + c`` for c in order + payload: the next row's values
    within ``keys`` ordered by ``order`` (NULL for the last row of a key).

    ``order`` must be unique within a key (dedupe first); its first column is
    the bucketed sequence.
    """
    keys, order, payload = list(keys), list(order), list(payload)
    fields = order + [c for c in payload if c not in order]
    bucket = bucket_of(df, order[0], bucket_unit)
    row = F.struct(*[F.col(c) for c in fields])

    # key and bucket as one struct: NULLs in either compare as equal in the join back
    key_bucket = F.struct(key_of(keys).alias("key"), bucket.alias("bucket"))
    d = df.withColumn("_kb", key_bucket)
    in_bucket = Window.partitionBy("_kb").orderBy(*order)
    d = d.withColumn("_nx", F.lead(row).over(in_bucket))

    # First row of every (key, bucket); the next bucket's head closes the tail.
    # A single carried column aggregates as a primitive (hash aggregate);
    # several need a struct (sort-based aggregate).
    head = F.struct(F.min(fields[0]).alias(fields[0])) if len(fields) == 1 else F.min(row)
    heads = df.select(*df.columns, key_bucket.alias("_kb")).groupBy("_kb").agg(head.alias("_head"))
    by_bucket = Window.partitionBy("_kb.key").orderBy("_kb.bucket")
    heads = heads.select("_kb", F.lead("_head").over(by_bucket).alias("_carry"))

    out = (d.join(heads, on="_kb", how="left")
           .withColumn("_nx", F.coalesce(F.col("_nx"), F.col("_carry"))))
    return out.select(*df.columns, *[F.col(f"_nx.{c}").alias(prefix + c) for c in fields])


def fill_within_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    columns: Sequence[str], bucket_unit: str | float | None = "day") -> DataFrame:
    """Replace NULLs with the key's latest earlier non-NULL value
    (``last_value(c IGNORE NULLS) over (partition by keys order by order)``).

    Same shape as ``next_within_key``: a running ``last`` inside each
    (key, time bucket), then a carry-in from the key's earlier buckets —
    a per-(key, bucket) summary, running over buckets per key, joined on the
    window's own partitioning.
    """
    keys, order, columns = list(keys), list(order), list(columns)
    key_bucket = F.struct(key_of(keys).alias("key"), bucket_of(df, order[0], bucket_unit).alias("bucket"))
    d = df.withColumn("_kb", key_bucket)
    run = Window.partitionBy("_kb").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    for c in columns:
        d = d.withColumn(f"_f_{c}", F.last(c, ignorenulls=True).over(run))

    def latest(c):
        pos = F.when(F.col(c).isNotNull(), F.struct(*[F.col(o) for o in order]))
        return F.max(F.struct(pos.alias("p"), F.col(c).alias("v")))

    summary = (df.withColumn("_kb", key_bucket).groupBy("_kb")
               .agg(*[latest(c).alias(f"_l_{c}") for c in columns]))
    earlier = Window.partitionBy("_kb.key").orderBy("_kb.bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select("_kb", *[F.max(f"_l_{c}").over(earlier).alias(f"_c_{c}") for c in columns])
    out = d.join(carry, on="_kb", how="left")
    filled = {c: F.coalesce(F.col(f"_f_{c}"), F.col(f"_c_{c}.v")).alias(c) for c in columns}
    return out.select(*[filled.get(c, F.col(c)) for c in df.columns])


def global_rank(df: DataFrame, order: Sequence[str], out: str = "rank",
                method: str = "rank", ascending: Sequence[bool] | None = None,
                num_partitions: int | None = None, attach: bool = True) -> DataFrame:
    """Global ``rank`` (gaps), ``dense_rank`` or ``row_number`` over ``order``.

    ``row_number`` needs a total order (unique ``order`` values). With
    ``attach=False`` only the distinct ``order`` values and their number come
    back (what key assignment needs).
    """
    if method not in ("rank", "dense_rank", "row_number"):
        raise ValueError(method)
    order = list(order)
    asc = list(ascending) if ascending is not None else [True] * len(order)
    sort = [F.col(c).asc() if a else F.col(c).desc() for c, a in zip(order, asc)]
    ensure_checkpoint_dir(df.sparkSession)

    if method == "row_number":
        # Total order: every row is its own group; carry the rows through
        # the checkpoint and skip the join back.
        groups = df
    else:
        groups = df.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
    ranged = (groups.repartitionByRange(num_partitions, *sort) if num_partitions
              else groups.repartitionByRange(*sort))
    # The id's high bits are the (ordered) partition, its low 33 bits the place
    # in it, so numbering needs no second exchange, only one offset a partition.
    ranged = (ranged.sortWithinPartitions(*sort).withColumn("_id", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    if method == "rank":
        # rows before a value: places are not enough, values have counts
        local = Window.partitionBy("_b").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
        ranged = ranged.withColumn("_b", part).withColumn(
            "_place", F.coalesce(F.sum("_n").over(local), F.lit(0)))
        size = F.sum("_n")
    else:
        ranged = ranged.withColumn("_b", part).withColumn("_place", place)
        size = F.count(F.lit(1))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_b").agg(size.alias("_rows"))
               .select("_b", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off")))
    value = (F.col("_off") + F.col("_place") + F.lit(1)).cast("bigint").alias(out)
    numbered = ranged.join(F.broadcast(offsets), "_b")
    if method == "row_number":
        return numbered.select(*df.columns, value)
    numbering = numbered.select(*order, value)
    if not attach:
        return numbering
    return same_key_join(df, numbering, order)


def version_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    row_out: str, dense_out: str, num_partitions: int | None = None
                    ) -> DataFrame:
    """One pass for both numberings of a versioned table:
    ``row_out``  = row_number() over (order by keys, order)   (surrogate key)
    ``dense_out``= dense_rank() over (order by keys)          (durable key)

    Rows are range-partitioned on (keys, order) and checkpointed; a key may
    straddle a partition boundary, so each partition reports its first and
    last key and a partition starting with the previous partition's last key
    does not count that key again. ``keys + order`` must be unique.
    """
    keys, order = list(keys), list(order)
    ensure_checkpoint_dir(df.sparkSession)
    by = [F.col(c) for c in keys + order]
    ranged = df.repartitionByRange(num_partitions, *by) if num_partitions else df.repartitionByRange(*by)
    ranged = (ranged.sortWithinPartitions(*by)
              .withColumn("_id", F.monotonically_increasing_id()).checkpoint(eager=True))
    ranged = ranged.withColumn("_b", F.shiftright("_id", 33)).withColumn(
        "_rn", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    key = key_of(keys)
    parts = (ranged.groupBy("_b")
             .agg(F.count(F.lit(1)).alias("_rows"), F.count_distinct(key).alias("_keys"),
                  F.min(key).alias("_first"), F.max(key).alias("_last")))
    prev = Window.orderBy("_b")
    before = prev.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn(
        "_cont", F.coalesce(F.col("_first") == F.lag("_last").over(prev), F.lit(False)))
    parts = parts.select(
        "_b", "_cont",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row_off"),
        F.coalesce(F.sum(F.col("_keys") - F.col("_cont").cast("int")).over(before),
                   F.lit(0)).alias("_key_off"))
    numbered = (ranged.withColumn("_dr", F.dense_rank().over(Window.partitionBy("_b").orderBy(*keys)))
                .join(F.broadcast(parts), "_b"))
    return numbered.select(
        *df.columns,
        (F.col("_row_off") + F.col("_rn")).cast("bigint").alias(row_out),
        (F.col("_key_off") + F.col("_dr") - F.col("_cont").cast("int")).cast("bigint")
        .alias(dense_out))


def key_numbers(df: DataFrame, keys: Sequence[str], first_out: str, dense_out: str,
                num_partitions: int | None = None) -> DataFrame:
    """Per distinct key, in key order: ``first_out``, the global number of its first row,
    and ``dense_out``, its place among the keys (both from 1).

    The rows themselves are only counted: what is range-partitioned, checkpointed and
    numbered is one row a key. A row's own number is ``first_out`` plus its place within
    the key.
    """
    keys = list(keys)
    ensure_checkpoint_dir(df.sparkSession)
    by = [F.col(c) for c in keys]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ranged = groups.repartitionByRange(num_partitions, *by) if num_partitions else groups.repartitionByRange(*by)
    ranged = (ranged.sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
              .checkpoint(eager=True).withColumn("_b", F.shiftright("_id", 33)))
    local = Window.partitionBy("_b").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_b").agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_keys")).select(
        "_b", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row_off"),
        F.coalesce(F.sum("_keys").over(before), F.lit(0)).alias("_key_off"))
    numbered = ranged.withColumn("_before", F.coalesce(F.sum("_n").over(local), F.lit(0))).join(F.broadcast(offsets), "_b")
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.select(*keys, (F.col("_row_off") + F.col("_before") + 1).cast("bigint").alias(first_out),
                           (F.col("_key_off") + place + 1).cast("bigint").alias(dense_out))


def row_number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                      out: str = "row_no") -> DataFrame:
    """``row_number() over (partition by keys order by order)`` without a
    per-key task: a global row number over (keys, order) minus the number of
    the key's first row (partial aggregate). ``keys + order`` must be unique.
    """
    keys, order = list(keys), list(order)
    numbered = global_rank(df, keys + order, out="_g", method="row_number")
    first = numbered.groupBy(*keys).agg(F.min("_g").alias("_g0"))
    return (same_key_join(numbered, first, keys)
            .withColumn(out, (F.col("_g") - F.col("_g0") + F.lit(1)).cast("int"))
            .drop("_g", "_g0"))
