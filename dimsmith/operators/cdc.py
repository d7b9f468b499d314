"""Apply a change feed to a keyed target (batch recompute form).

Semantics (per KEYS, ordered by SEQUENCE BY):
  * SCD 1 — one row per key, the values of the change with the greatest
    sequence; older rows arriving late are ignored.
  * SCD 2 — one row per change; ``start_at`` = its sequence, ``end_at`` = the
    next change's sequence, NULL for the current version.
  * ``where``            source filter applied first.
  * ``apply_as_truncates`` every change with a sequence <= the latest truncate
    event disappears (the truncate rows themselves are never data).
  * ``apply_as_deletes`` SCD 1: a key whose latest change is a delete is gone;
    SCD 2: the delete closes the open version and is not a version itself.
  * ``ignore_null_updates`` a NULL in a change keeps the previous value.
  * ``columns`` / ``except_columns`` choose the stored attribute columns.
  * ``tiebreak`` orders changes with an equal sequence (greatest wins); without
    it (keys, sequence) must be unique.

The incremental (streaming) form in ``dimsmith.streaming.apply_changes``
produces the same target from any split of the feed into micro-batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.operators.ordered import fill_within_key, next_within_key
from dimsmith.operators.same_key import same_key_join

START_AT = "start_at"
END_AT = "end_at"


@dataclass
class ChangeSpec:
    keys: list[str]
    sequence_by: str
    stored_as_scd_type: int = 1
    columns: list[str] | None = None
    except_columns: list[str] | None = None
    where: str | None = None
    ignore_null_updates: bool = False
    apply_as_deletes: str | None = None
    apply_as_truncates: str | None = None
    tiebreak: list[str] = field(default_factory=list)
    bucket_unit: str | float | None = "day"

    def __post_init__(self):
        self.stored_as_scd_type = int(self.stored_as_scd_type)
        if self.stored_as_scd_type not in (1, 2):
            raise ValueError("stored_as_scd_type must be 1 or 2")
        if self.columns and self.except_columns:
            raise ValueError("give columns or except_columns, not both")

    def attributes(self, df: DataFrame) -> list[str]:
        fixed = set(self.keys) | {self.sequence_by}
        if self.columns:
            return [c for c in self.columns if c not in fixed]
        dropped = {c.lower() for c in (self.except_columns or [])}
        return [c for c in df.columns if c not in fixed and c.lower() not in dropped]


def _cond(expr: str | Column | None) -> Column | None:
    if expr is None:
        return None
    return F.expr(expr) if isinstance(expr, str) else expr


def truncate_rows(df: DataFrame, spec: ChangeSpec) -> DataFrame | None:
    """The feed's truncate events (after the source filter)."""
    trunc = _cond(spec.apply_as_truncates)
    if trunc is None:
        return None
    where = _cond(spec.where)
    return (df if where is None else df.where(where)).where(trunc)


def _drop_truncated(df: DataFrame, spec: ChangeSpec, at: Column | None) -> DataFrame:
    """Changes later than the latest truncate (``at``, or the feed's own)."""
    trunc = _cond(spec.apply_as_truncates)
    if trunc is None:
        return df
    if at is None:
        # Scalar subquery: the latest truncate sequence, planned once, no join.
        at = df.where(trunc).agg(F.max(spec.sequence_by).alias("_t")).scalar()
    return df.where(at.isNull() | (F.col(spec.sequence_by) > at))


def _dedupe(df: DataFrame, spec: ChangeSpec, carry: list[str]) -> DataFrame:
    """One change per (keys, sequence): the greatest ``tiebreak`` wins."""
    if not spec.tiebreak:
        return df
    group = spec.keys + [spec.sequence_by]
    rest = [c for c in carry if c not in group]
    tb = [c for c in spec.tiebreak if c not in group]
    best = F.max(F.struct(*[F.col(c) for c in tb + [c for c in rest if c not in tb]]))
    return (df.groupBy(*group).agg(best.alias("_b"))
            .select(*group, *[F.col(f"_b.{c}").alias(c) for c in rest]))


def prepare_changes(source: DataFrame, spec: ChangeSpec, truncated_at: Column | None = None
                    ) -> tuple[DataFrame, list[str], bool]:
    """Filter, truncate, flag deletes, project and dedupe a change feed.

    ``truncated_at``: the latest truncate known, where it is not the feed's own.

    Returns (keys + sequence + attributes [+ _is_delete], attributes, has_delete).
    """
    df = source
    where = _cond(spec.where)
    if where is not None:
        df = df.where(where)
    df = _drop_truncated(df, spec, truncated_at)
    attrs = spec.attributes(df)
    delete = _cond(spec.apply_as_deletes)
    carry = attrs + [c for c in spec.tiebreak if c not in attrs]
    if delete is not None:
        df = df.withColumn("_is_delete", F.coalesce(delete, F.lit(False)))
        carry = carry + ["_is_delete"]
    df = df.select(*spec.keys, spec.sequence_by, *[c for c in carry if c not in spec.keys])
    return _dedupe(df, spec, carry), attrs, delete is not None


def apply_changes(source: DataFrame, spec: ChangeSpec) -> DataFrame:
    df, attrs, has_delete = prepare_changes(source, spec)
    if spec.stored_as_scd_type == 1:
        return _scd1(df, spec, attrs, has_delete)
    return _scd2(df, spec, attrs, has_delete)


def _scd1(df: DataFrame, spec: ChangeSpec, attrs: list[str], has_delete: bool,
          keep_tombstones: bool = False) -> DataFrame:
    keys, seq = spec.keys, spec.sequence_by
    order = [seq] + [c for c in spec.tiebreak if c != seq]
    if has_delete and spec.ignore_null_updates:
        # Values before the latest delete of a key must not leak into a re-insert.
        last_del = (df.where("_is_delete").groupBy(*keys)
                    .agg(F.max(seq).alias("_last_del")))
        df = (same_key_join(df, last_del, keys, "left")
                .where(F.col("_last_del").isNull() | (F.col(seq) >= F.col("_last_del")))
                .drop("_last_del"))
    fields = order + [a for a in attrs if a not in order] + (["_is_delete"] if has_delete else [])
    latest = F.max(F.struct(*[F.col(c) for c in fields]))
    aggs = [latest.alias("_l")]
    if spec.ignore_null_updates:
        # Per column: the value of the latest change where it is not NULL.
        for c in attrs:
            has_value = F.col(c).isNotNull()
            if has_delete:
                has_value = has_value & ~F.col("_is_delete")  # a delete supplies no values
            pos = F.when(has_value, F.struct(*[F.col(o) for o in order]))
            val = F.when(has_value, F.col(c))
            aggs.append(F.max(F.struct(pos.alias("p"), val.alias("v"))).alias(f"_nn_{c}"))
    out = df.groupBy(*keys).agg(*aggs)
    values = [(F.col(f"_nn_{c}.v") if spec.ignore_null_updates else F.col(f"_l.{c}")).alias(c)
              for c in attrs]
    if keep_tombstones:
        flag = F.col("_l._is_delete") if has_delete else F.lit(False)
        return out.select(*keys, F.col(f"_l.{seq}").alias(seq), *values, flag.alias("_is_delete"))
    if has_delete:
        out = out.where(~F.col("_l._is_delete"))
    return out.select(*keys, F.col(f"_l.{seq}").alias(seq), *values)


def _scd2(df: DataFrame, spec: ChangeSpec, attrs: list[str], has_delete: bool,
          keep_tombstones: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    keys, seq = spec.keys, spec.sequence_by
    if spec.ignore_null_updates and not has_delete:
        # A NULL in a change keeps the previous version's value.
        df = fill_within_key(df, keys, [seq], attrs, bucket_unit=spec.bucket_unit)
    elif spec.ignore_null_updates:
        # Same, but a value never carries across a delete: fill (sequence,
        # value) pairs and the latest delete's sequence, keep values newer
        # than that delete.
        tagged = df.select(
            *df.columns, F.when(F.col("_is_delete"), F.col(seq)).alias("_del"),
            *[F.when(F.col(a).isNotNull(), F.struct(F.col(seq).alias("s"), F.col(a).alias("v")))
              .alias(f"_p_{a}") for a in attrs])
        filled = fill_within_key(tagged, keys, [seq], ["_del"] + [f"_p_{a}" for a in attrs],
                                 bucket_unit=spec.bucket_unit)
        keep = {a: F.when(F.col("_del").isNull() | (F.col(f"_p_{a}.s") > F.col("_del")),
                          F.col(f"_p_{a}.v")).alias(a) for a in attrs}
        df = filled.select(*[keep.get(c, F.col(c)) for c in df.columns])
    chained = next_within_key(df, keys, [seq], prefix="_next_", bucket_unit=spec.bucket_unit)
    out = [*keys, *attrs, F.col(seq).alias(START_AT), F.col(f"_next_{seq}").alias(END_AT),
           *carry]
    if keep_tombstones:
        flag = F.col("_is_delete") if has_delete else F.lit(False)
        return chained.select(*out, flag.alias("_is_delete"))
    if has_delete:
        chained = chained.where(~F.col("_is_delete"))
    return chained.select(*out)
