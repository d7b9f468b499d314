"""Incremental apply-changes: a change stream maintains a keyed target.

Every micro-batch, in ``foreachBatch``, writes the target's next complete
snapshot as plain Parquet (``write_snapshot`` with the batch's number):

    <root>/data/v=<batch>     stored rows, delete markers included
    <root>/truncated/v=<batch>  one row: the greatest truncate so far, if any

1. a batch whose snapshot is complete (replay after a crash) is skipped; a crash
   before that leaves the snapshot before it in force, and the replay writes its
   own anew, so readers see whole batches only;
2. the batch is normalised like the batch operator (``prepare_changes``) and
   persisted, as it is used several times;
3. keys touched by the batch are recomputed from stored rows and changes, other
   keys are carried over;
   SCD 1: greatest sequence per key; deletes are stored as tombstones so a
   late, older change cannot revive a key;
   SCD 2: stored versions and delete markers are turned back into changes and
   the key's chain is rebuilt with ``next_within_key``, which splices late rows
   in; on an equal (key, sequence) the greater tie-break wins, stored or new;
4. the greatest truncate sequence is kept with the target: rows at or below it
   vanish in every later batch and in what readers see.

So the result does not depend on how the feed is split into batches. NULL key
parts are equal to each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dimsmith.operators.cdc import (START_AT, ChangeSpec, _dedupe, _scd1, _scd2, prepare_changes,
                                    truncate_rows)
from dimsmith.operators.same_key import same_key_join
from dimsmith.sinks.files import latest_snapshot, snapshot_versions, write_snapshot

TOMBSTONE = "_is_delete"


# ------------------------------------------------------------ merge
def _sequence_of(spec: ChangeSpec) -> str:
    return START_AT if spec.stored_as_scd_type == 2 else spec.sequence_by


def _after_truncate(stored: DataFrame, spec: ChangeSpec, at: Column | None) -> DataFrame:
    """Stored rows (and column values) that a truncate at ``at`` leaves."""
    if at is None:
        return stored
    out = stored.where(F.col(_sequence_of(spec)) > at)
    for c in stored.columns:
        if c.startswith("_pos_"):
            live = F.col(f"{c}.{spec.sequence_by}") > at
            value = c[len("_pos_"):]
            if value in stored.columns and value not in (spec.sequence_by, *spec.tiebreak):
                out = out.withColumn(value, F.when(live, F.col(value)))
            out = out.withColumn(c, F.when(live, F.col(c)))
    if "_last_del" in stored.columns:
        out = out.withColumn("_last_del", F.when(F.col(f"_last_del.{spec.sequence_by}") > at, F.col("_last_del")))
    return out


def merge_batch(prev: DataFrame | None, batch: DataFrame, spec: ChangeSpec,
                truncated_at: Column | None = None, recompute_all: bool = False,
                written: Observation | None = None) -> DataFrame:
    """Next stored rows from the previous ones and one batch of changes.

    ``recompute_all`` rebuilds every stored key, not only touched ones;
    ``written`` observes the visible rows of rebuilt keys (``rows``).
    """
    changes, attrs, has_delete = prepare_changes(batch, spec, truncated_at)
    keys, seq = spec.keys, spec.sequence_by
    if not has_delete:
        changes = changes.withColumn(TOMBSTONE, F.lit(False))
    # Tie-break columns travel with the stored rows so late changes still order.
    attrs = attrs + [c for c in spec.tiebreak if c not in attrs and c not in keys and c != seq]
    changes = changes.select(*keys, seq, *attrs, TOMBSTONE)
    old = rest = None
    if prev is not None:
        prev = _after_truncate(prev, spec, truncated_at)
        if recompute_all:
            old = prev
        else:
            touched = changes.select(*keys).distinct()
            old = same_key_join(prev, touched, keys, "left_semi")
            rest = same_key_join(prev, touched, keys, "left_anti")

    if spec.stored_as_scd_type == 1 and spec.ignore_null_updates:
        fresh = _merge_scd1_ignore_nulls(old, changes, spec, attrs)
    elif spec.stored_as_scd_type == 1:
        rows = changes if old is None else old.select(*keys, seq, *attrs, TOMBSTONE).unionByName(changes)
        fresh = _scd1(rows, spec, attrs, True, keep_tombstones=True)
    else:
        # With ignore-null updates the stored versions hold filled values; the raw
        # change values travel in hidden columns so a touched key's whole chain is
        # re-filled from raw values (a late change may fill the versions after it).
        raw = [f"_raw_{a}" for a in attrs] if spec.ignore_null_updates else []
        chain = changes.select(*changes.columns, *[F.col(a).alias(f"_raw_{a}") for a in attrs]) if raw else changes
        if old is not None:
            values = [F.col(f"_raw_{a}").alias(a) for a in attrs] if raw else attrs
            stored = old.select(*keys, F.col(START_AT).alias(seq), *values, TOMBSTONE, *raw)
            if spec.tiebreak:
                chain = _dedupe(stored.unionByName(chain), spec, [*attrs, TOMBSTONE, *raw])
            else:       # (key, sequence) is unique: an equal change is the stored one, replayed
                chain = stored.unionByName(same_key_join(chain, stored.select(*keys, seq), [*keys, seq], "left_anti"))
        fresh = _scd2(chain, spec, attrs, True, keep_tombstones=True, carry=raw)
    if written is not None:
        fresh = fresh.observe(written, F.count_if(~F.col(TOMBSTONE)).alias("rows"))
    return fresh if rest is None else rest.unionByName(fresh.select(*rest.columns))


def _merge_scd1_ignore_nulls(old, changes, spec, attrs):
    """SCD 1 + IGNORE NULL UPDATES, order-independent across batches: the
    target keeps, per column, the sequence of the value it holds (``_pos_c``)
    and the key's latest delete (``_last_del``), so a late change is merged per
    column exactly as the one-shot computation would."""
    keys, seq = spec.keys, spec.sequence_by
    order = [seq] + [c for c in spec.tiebreak if c != seq]
    pos = lambda c: F.when(F.col(c).isNotNull(), F.struct(*[F.col(o) for o in order]))
    rows = changes.select(
        *keys, *order, *[a for a in attrs if a not in order], TOMBSTONE,
        *[pos(a).alias(f"_pos_{a}") for a in attrs],
        F.when(F.col(TOMBSTONE), F.struct(*[F.col(o) for o in order])).alias("_last_del"))
    if old is not None:
        rows = old.select(*rows.columns).unionByName(rows)
    agg = rows.groupBy(*keys).agg(
        F.max(F.struct(*[F.col(o) for o in order], F.col(TOMBSTONE))).alias("_l"),
        F.max("_last_del").alias("_last_del"),
        *[F.max(F.struct(F.col(f"_pos_{a}").alias("p"), F.col(a).alias("v"))).alias(f"_n_{a}")
          for a in attrs])
    live = lambda a: F.col("_last_del").isNull() | (F.col(f"_n_{a}.p") > F.col("_last_del"))
    return agg.select(
        *keys, *[F.col(f"_l.{o}").alias(o) for o in order],
        *[F.when(live(a), F.col(f"_n_{a}.v")).alias(a) for a in attrs if a not in order],
        F.col(f"_l.{TOMBSTONE}").alias(TOMBSTONE),
        *[F.when(live(a), F.col(f"_n_{a}.p")).alias(f"_pos_{a}") for a in attrs],
        "_last_del")


def visible(stored: DataFrame, spec: ChangeSpec) -> DataFrame:
    """What readers see: delete markers (tombstones) and bookkeeping removed."""
    hidden = [c for c in stored.columns
              if c.startswith(("_pos_", "_raw_")) or c == "_last_del"]
    unwanted = {c.lower() for c in spec.except_columns or []}
    hidden += [c for c in spec.tiebreak if c in stored.columns and c not in spec.keys
               and (c.lower() in unwanted or spec.columns and c not in spec.columns)]
    if TOMBSTONE in stored.columns:
        stored = stored.where(~F.col(TOMBSTONE)).drop(TOMBSTONE)
    return stored.drop(*hidden)


def _truncate_mark(spark: SparkSession, root: str, version: int) -> str | None:
    return spark.read.parquet(f"{root}/truncated/v={version}").first()[0]


def read_target(spark: SparkSession, root: str, spec: ChangeSpec) -> DataFrame | None:
    """The target as of its newest complete snapshot."""
    root = root.rstrip("/")
    versions = snapshot_versions(spark, f"{root}/data")
    if not versions:
        return None
    stored, mark = latest_snapshot(spark, f"{root}/data"), _truncate_mark(spark, root, versions[-1])
    at = None if mark is None else F.lit(mark).cast(stored.schema[_sequence_of(spec)].dataType)
    return visible(_after_truncate(stored, spec, at), spec)


def merge_into_target(spark: SparkSession, batch: DataFrame, spec: ChangeSpec, root: str, batch_id: int,
                      files: int | None = None) -> int | None:
    """Write the target's snapshot ``batch_id``; the visible rows of touched keys, None if it was written before.

    ``files``: deal the snapshot's rows to so many files by key (default: as they come).
    """
    root = root.rstrip("/")
    versions = snapshot_versions(spark, f"{root}/data")
    if batch_id in versions:
        return None                                 # complete before a restart
    prev = latest_snapshot(spark, f"{root}/data")
    mark = _truncate_mark(spark, root, versions[-1]) if versions else None
    batch = batch.persist()
    try:
        seq_type, before = batch.schema[spec.sequence_by].dataType, mark
        trunc = truncate_rows(batch, spec)
        if trunc is not None:
            newest = trunc.agg(F.max(spec.sequence_by).alias("t")).select(
                F.greatest("t", F.lit(mark).cast(seq_type)).cast("string")).first()[0]
            mark = newest if newest is not None else mark
        at = None if mark is None else F.lit(mark).cast(seq_type)
        # filled values of untouched keys may come from rows that are truncated now
        refill = mark != before and spec.ignore_null_updates and spec.stored_as_scd_type == 2
        written = Observation(f"written_{uuid.uuid4().hex[:8]}")
        fresh = merge_batch(prev, batch, spec, at, refill, written)
        if files:
            fresh = fresh.repartition(files, *[F.col(k) for k in spec.keys])
        # the mark first: the data's success marker completes the batch
        write_snapshot(spark.createDataFrame([(mark,)], "truncated_at string").coalesce(1), f"{root}/truncated", batch_id)
        write_snapshot(fresh, f"{root}/data", batch_id)
        return int(written.get["rows"])
    finally:
        batch.unpersist()


def apply_changes_stream(changes: DataFrame, spec: ChangeSpec, target_root: str,
                         checkpoint: str, available_now: bool = True,
                         processing_time: str | None = None,
                         buckets: int | None = None,
                         on_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    """Start the incremental apply; triggered (availableNow) or continuous.

    ``buckets``: files of a snapshot, a key's rows together; ``on_batch`` hears
    how many visible rows a batch wrote for the keys it touched.
    """
    spark = changes.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = merge_into_target(spark, batch, spec, target_root, int(batch_id), buckets)
        if rows is not None and on_batch:
            on_batch(rows)

    writer = changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time or "1 minute"))
    return writer.start()
