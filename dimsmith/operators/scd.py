"""SCD 2 / SCD 7 dimension maintenance: merge, current view, checks, backfill.

``scd2_merge`` takes a dimension snapshot and an attribute snapshot of the
source and returns the next dimension snapshot (parquet has no MERGE, so the
result is written as a new snapshot by the caller). Current rows and updates
meet in one full outer join on the business key; each joined row expands to
at most two output rows (untouched / closed + new version / new member).
New rows are numbered after the current maximum surrogate and durable keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.scalars import OPEN_END
from dimsmith.operators.keys import assign_durable_keys, assign_surrogate_keys
from dimsmith.operators.same_key import same_key_join


@dataclass
class DimSpec:
    business_keys: list[str]
    attributes: list[str]
    sk: str = "sk"
    dk: str = "dk"
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    is_current: str = "is_current"

    def columns(self) -> list[str]:
        return [self.sk, self.dk, *self.business_keys, *self.attributes,
                self.valid_from, self.valid_to, self.is_current]


def _date(d: dt.date | str | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def scd2_merge(dim: DataFrame, updates: DataFrame, spec: DimSpec,
               run_date: dt.date | str, reopen: bool = False,
               same_day: str = "replace", last_keys: tuple[int, int] | None = None) -> DataFrame:
    """Next SCD 2 snapshot of ``dim`` given ``updates`` (one row per business key).

    (a) key never seen -> new member, new durable key;
    (b) current row differs (NULL-safe, per attribute) -> close it
        (valid_to = run_date - 1, not current) and add a version with the same
        durable key from run_date to the open end; if the current row started
        on run_date itself it is replaced in place (``same_day='replace'``);
    (c) unchanged -> nothing;  (d) key absent from ``updates`` -> nothing.
    A key whose rows are all closed is left alone unless ``reopen``. NULLs in
    a key are equal to each other; a NULL current flag means not current.

    Only current rows (at most one per key) meet the updates (one per key) in
    the full outer join, so no join side can be skewed; closed versions pass
    straight through, and "never seen" is a left-anti test against the
    distinct keys of the dimension (a partial aggregate).

    ``last_keys``: the largest surrogate and durable key in use, where ``dim``
    is only a part of the dimension (default: the largest in ``dim``).
    """
    keys, attrs = spec.business_keys, spec.attributes
    run = _date(run_date)
    cols = spec.columns()
    is_current = F.coalesce(F.col(spec.is_current), F.lit(False))
    current = dim.where(is_current).select(*cols, F.lit(True).alias("_in_dim"))
    closed = dim.where(~is_current).select(*cols)
    types = {f.name: f.dataType for f in dim.schema.fields}
    u = updates.select(*[F.col(k).cast(types[k]).alias(k) for k in keys], *[F.col(a).alias(f"_u_{a}") for a in attrs],
                       F.lit(True).alias("_in_upd"))
    known = dim.groupBy(*keys).agg(F.max(spec.dk).alias("_known_dk"))
    j = same_key_join(same_key_join(current, u, keys, "full_outer"), known, keys, "left")

    in_dim = F.coalesce(F.col("_in_dim"), F.lit(False))
    changed = F.lit(False)
    for a in attrs:
        changed = changed | ~F.col(a).eqNullSafe(F.col(f"_u_{a}"))
    hit = in_dim & F.col("_in_upd").isNotNull() & changed
    replace = (hit & (F.col(spec.valid_from) == run)) if same_day == "replace" else F.lit(False)
    close = hit & ~replace
    unseen = ~in_dim & F.col("_known_dk").isNull()
    reopened = ~in_dim & F.col("_known_dk").isNotNull() & F.lit(bool(reopen))

    def row(sk, dk, attr_src, vf, vt, cur, kind):
        return F.struct(sk.cast("bigint").alias(spec.sk), dk.cast("bigint").alias(spec.dk),
                        *[F.col(k).alias(k) for k in keys],
                        *[F.col(f"{attr_src}{a}").alias(a) for a in attrs],
                        vf.alias(spec.valid_from), vt.alias(spec.valid_to),
                        cur.alias(spec.is_current), F.lit(kind).alias("_kind"))

    null_id = F.lit(None).cast("bigint")
    kept = row(F.col(spec.sk), F.col(spec.dk), "", F.col(spec.valid_from),
               F.col(spec.valid_to), F.col(spec.is_current), "kept")
    replaced = row(F.col(spec.sk), F.col(spec.dk), "_u_", F.col(spec.valid_from),
                   F.col(spec.valid_to), F.lit(True), "kept")
    closing = row(F.col(spec.sk), F.col(spec.dk), "", F.col(spec.valid_from),
                  F.date_sub(run, 1), F.lit(False), "kept")
    version = row(null_id, F.col(spec.dk), "_u_", run, F.lit(OPEN_END), F.lit(True), "version")
    again = row(null_id, F.col("_known_dk"), "_u_", run, F.lit(OPEN_END), F.lit(True), "version")
    member = row(null_id, null_id, "_u_", run, F.lit(OPEN_END), F.lit(True), "member")

    out_rows = (F.when(replace, F.array(replaced))
                .when(close, F.array(closing, version))
                .when(in_dim, F.array(kept))
                .when(unseen, F.array(member))
                .when(reopened, F.array(again)))  # otherwise NULL: explode emits nothing
    touched = j.select(F.explode(out_rows).alias("r")).select("r.*").checkpoint(eager=True)

    old = touched.where(F.col("_kind") == "kept").drop("_kind")
    new = touched.where(F.col("_kind") != "kept")
    if last_keys is None:
        max_sk = dim.agg(F.coalesce(F.max(spec.sk), F.lit(0)).alias("m")).scalar()
        max_dk = dim.agg(F.coalesce(F.max(spec.dk), F.lit(0)).alias("m")).scalar()
    else:
        max_sk, max_dk = (F.lit(k).cast("bigint") for k in last_keys)

    members = new.where(F.col("_kind") == "member").drop(spec.dk)
    members = assign_durable_keys(members, keys, out=spec.dk, start=max_dk)
    versions = new.where(F.col("_kind") == "version")
    fresh = versions.unionByName(members).drop(spec.sk, "_kind")
    fresh = assign_surrogate_keys(fresh, keys, out=spec.sk, start=max_sk)
    return (closed.unionByName(old.select(*cols))
            .unionByName(fresh.select(*cols)))


def current_view(dim: DataFrame, spec: DimSpec, prefix: str = "current_") -> DataFrame:
    """SCD 1-like view: durable key + current attribute values."""
    return dim.where(F.col(spec.is_current)).select(
        spec.dk, *[F.col(a).alias(prefix + a) for a in spec.attributes])


def create_current_view(dim: DataFrame, spec: DimSpec, name: str, prefix: str = "current_") -> DataFrame:
    """``current_view`` registered in the session under ``name`` for SQL readers."""
    view = current_view(dim, spec, prefix)
    view.createOrReplaceTempView(name)
    return view


def duplicate_keys(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Key values occurring more than once (empty = unique). Partial aggregation."""
    src = df if where is None else df.where(where)
    return (src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: number of NULLs per column (all zero = check passes)."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(f"{c}_nulls") for c in columns])


def backfill_from(fact: DataFrame, dim: DataFrame, via: str, columns: Sequence[str]) -> DataFrame:
    """UPDATE fact SET c = dim.c FROM dim WHERE dim.via = fact.via (left join)."""
    look = dim.select(via, *[F.col(c).alias(f"_bf_{c}") for c in columns])
    out = fact.join(look, on=via, how="left")
    for c in columns:
        if c in fact.columns:
            out = out.withColumn(c, F.coalesce(F.col(f"_bf_{c}"), F.col(c)))
        else:
            out = out.withColumn(c, F.col(f"_bf_{c}"))
    return out.drop(*[f"_bf_{c}" for c in columns])
