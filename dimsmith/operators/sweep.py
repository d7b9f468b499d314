"""Validity-range lookup by a sweep over one sorted stream.

``sweep_join`` finds the version of a dimension that holds at each fact's time,
like ``temporal_join``, without listing a version once per period it lives in.
Facts and versions form one stream ordered by (key, time, versions first); the
version in force at a fact is the last one before it, if it is of the fact's key
and has not ended.

The stream is cut into blocks: by a hash of the key, and a key that holds more
than a block's share of a sample is cut further into ranges of time, at bounds
drawn from the sample. Within a block a running ``last`` carries the version
forward; what is in force where a range begins is the last version of the key's
ranges before it (one row a range, from the dimension alone). So facts are
shuffled once, every version once, and a hot key, or a hot (key, time), is
spread over as many blocks as it has rows for: bounds hold a short hash of the
fact beside the time. A version's time and end travel once, not again among its columns. Only keys that hold a share of the sample have bounds, so their
table is broadcast whatever the number of keys.

Versions of a key must not overlap (as SCD 2 keeps them); one that ends before
it begins, or with a NULL end, holds at no time. NULL keys and times match
nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimsmith.operators.ordered import row_number_within
from dimsmith.session import ensure_checkpoint_dir

SAMPLE_PER_BLOCK = 32
SALT_BITS = 20
_PLACE = ["t", "kind", "salt"]


def hot_ranges(stream: DataFrame, blocks: int) -> DataFrame:
    """(hk, bounds): the bounds of keys with two blocks' share of a sample (the smallest hashes) or more.

    One row a hot key, ``blocks / 2`` at most; checkpointed, so that every reader sees the same bounds.
    """
    sample = (stream.select("k", F.struct(*_PLACE).alias("p"), F.xxhash64(F.lit(3), "k", *_PLACE).alias("h")).orderBy("h")
              .limit(blocks * SAMPLE_PER_BLOCK))
    keys = sample.groupBy(F.col("k").alias("hk")).agg(F.array_sort(F.collect_list("p")).alias("ps")).where(
        F.size("ps") >= 2 * SAMPLE_PER_BLOCK)
    every = F.transform(F.sequence(F.lit(1), F.floor(F.size("ps") / SAMPLE_PER_BLOCK).cast("int")),
                        lambda i: F.get("ps", i * SAMPLE_PER_BLOCK - 1))
    return keys.select("hk", F.array_distinct(every).alias("bounds")).checkpoint(eager=True)


def with_block(stream: DataFrame, hot: DataFrame, blocks: int) -> DataFrame:
    """``part`` (hash of the key) and ``piece`` (bounds at or below the row's place; 0 for other keys)."""
    place = F.struct(*_PLACE)
    piece = F.when(F.col("bounds").isNull(), 0).otherwise(F.size(F.filter("bounds", lambda b: b <= place)))
    return stream.join(F.broadcast(hot), F.col("k") == F.col("hk"), "left").withColumn(
        "part", F.pmod(F.xxhash64("k"), F.lit(blocks))).withColumn("piece", piece).drop("hk", "bounds")


def sweep_join(facts: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]] | Sequence[str], at: str,
               valid_from: str = "valid_from", valid_to: str = "valid_to", how: str = "inner",
               unknown_member: Mapping[str, object] | None = None, blocks: int | None = None,
               sample: DataFrame | None = None, strictly: bool = False, ends: bool = True) -> DataFrame:
    """Join ``facts`` to the ``dim`` version valid at ``facts[at]`` (both ends inclusive).

    ``on``: fact / dim key pairs (or shared names); the columns of both sides keep
    their names. ``how``: inner or left; ``unknown_member``: values for the named
    dim columns of facts without a version, which are then kept. ``blocks``: how
    many blocks to aim at (default: four a shuffle partition). ``sample``: rows
    with the facts' keys and time to draw the bounds from, where ``facts`` itself
    is dear to compute twice. ``strictly``: versions that begin at the fact's
    time do not hold yet (the one before is then looked at). ``ends`` False: a version
    holds until the next one of its key, whatever ``valid_to`` says.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    spark = facts.sparkSession
    ensure_checkpoint_dir(spark)
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    blocks = max(2, blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared = [f for f, d in pairs if f == d]
    dim_columns = [c for c in dim.columns if c not in shared]
    carried_columns = [c for c in dim_columns if c not in (valid_from, valid_to)] or dim_columns
    time = dim.schema[valid_from].dataType

    def keys(names):
        return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(names)])
    versions = dim.where(F.col(valid_from) <= F.col(valid_to)).select(
        keys([d for _, d in pairs]).alias("k"), F.col(valid_from).alias("t"), F.lit(0).alias("kind"),
        F.lit(0).cast("long").alias("salt"), F.col(valid_to).alias("end"), F.struct(*carried_columns).alias("v"))

    def places(rows):
        return rows.select(keys([f for f, _ in pairs]).alias("k"), F.col(at).cast(time).alias("t"), F.lit(-1 if strictly else 1).alias("kind"),
                           F.xxhash64(*rows.columns).bitwiseAND(F.lit((1 << SALT_BITS) - 1)).alias("salt"), *([F.struct(*rows.columns).alias("f")] if rows is facts else []))
    f = places(facts)
    drawn = (places(sample) if sample is not None else f).select("k", *_PLACE).unionByName(versions.select("k", *_PLACE))
    hot = hot_ranges(drawn, blocks)

    stream = with_block(versions.unionByName(f, allowMissingColumns=True), hot, blocks)
    running = Window.partitionBy("part", "piece").orderBy("k", *_PLACE, "end").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    held = F.last(F.when(F.col("kind") == 0, F.struct("k", "t", "end", "v")), ignorenulls=True).over(running)

    # what is in force where a range of a hot key begins: the last version of its ranges before
    ranges = hot.select("hk", F.explode(F.sequence(F.lit(0), F.size("bounds"))).alias("piece"))
    mine = with_block(versions, hot, blocks).join(F.broadcast(hot.select("hk")), F.col("k") == F.col("hk")).groupBy("hk", "piece").agg(
        F.max_by(F.struct("k", "t", "end", "v"), F.struct("t", "end")).alias("last"))
    before = Window.partitionBy("hk").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.join(mine, ["hk", "piece"], "left").select(
        "hk", "piece", F.last("last", ignorenulls=True).over(before).alias("carried")).where("piece > 0")

    x = stream.withColumn("held", held).where("kind <> 0").join(
        F.broadcast(carried.withColumnRenamed("piece", "_piece")), (F.col("k") == F.col("hk")) & (F.col("piece") == F.col("_piece")), "left")
    # in a hash block another key may come before: then nothing of the own key is in force
    x = x.withColumn("held", F.coalesce(F.when(F.col("held.k") == F.col("k"), F.col("held")), F.col("carried")))
    same = F.lit(True)
    for i in range(len(pairs)):     # NULL keys match nothing
        same = same & (F.col(f"k.k{i}") == F.col(f"held.k.k{i}"))
    if ends:
        same = same & (F.col("t") <= F.col("held.end"))
    found = F.coalesce(same & F.col("t").isNotNull(), F.lit(False))
    if how == "inner" and not unknown_member:
        x = x.where(found)
    fallback = dict(unknown_member or {})
    return x.select(
        *[F.col(f"f.`{c}`").alias(c) for c in facts.columns],
        *[F.when(found, F.col({valid_from: "held.t", valid_to: "held.end"}.get(c, f"held.v.`{c}`"))).otherwise(F.lit(fallback.get(c))).alias(c) for c in dim_columns])


def latest_before(rows: DataFrame, others: DataFrame, on: Sequence[tuple[str, str]], at: str, when: str,
                  tiebreak: Sequence[str], k: int = 1, place: str = "place") -> DataFrame:
    """For each row the ``k`` latest of ``others`` with its keys and ``when`` before ``at``, numbered from 1.

    What a lateral subquery with an order and a limit of its own gives. Spark turns
    such a subquery into a join of all distinct times with all other rows; here the
    others are numbered within their key, a sweep finds the number of the last one
    before each row, and the k numbers up to it are an equi-join. ``when`` and
    ``tiebreak`` must be unique within a key; column names of the two sides must differ.
    """
    keys, number = [d for _, d in on], "_nth"
    numbered = row_number_within(others, keys, [when, *tiebreak], out=number).where(F.col(when).isNotNull()).checkpoint(eager=True)
    last = numbered.groupBy(*keys, when).agg(F.max(number).alias("_last")).select(
        *[F.col(d).alias(f"_k{i}") for i, d in enumerate(keys)], F.col(when).alias("_from"), F.col(when).alias("_to"), "_last")
    found = sweep_join(rows, last, [(a, f"_k{i}") for i, (a, _) in enumerate(on)], at, "_from", "_to", strictly=True, ends=False)
    wanted = found.withColumn(place, F.explode(F.sequence(F.lit(1), F.least(F.lit(k), F.col("_last")))))
    meet = F.col("_last") - F.col(place) + 1 == F.col(number)
    for i, d in enumerate(keys):
        meet = meet & (F.col(f"_k{i}") == F.col(d))
    return wanted.join(numbered, meet).select(*rows.columns, place, *others.columns)
