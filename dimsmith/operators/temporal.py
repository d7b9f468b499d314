"""Temporal (validity-range) lookups of SCD 2 dimensions.

``temporal_join``: fact rows pick the version whose [valid_from, valid_to]
(inclusive) holds the fact date, matched on the business or durable key.
An equi-join on the key alone compares every fact row of a key with every
version of it; a hot key with many versions turns that into a long nested
loop in one task. We add a coarse date bucket (year by default) to the join
key: each version is listed once per bucket it overlaps (capped at the
latest fact date, a scalar subquery), so per bucket only the versions alive
in that bucket are compared and the join key spreads a hot key over buckets.

``as_of``: the version of every key valid on one date (then a plain
equi-join on the key, at most one row per key).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bucket(c: Column, unit: str) -> Column:
    if unit == "year":
        return F.year(c)
    if unit == "month":
        return F.year(c) * 12 + F.month(c)
    raise ValueError(f"unknown bucket unit {unit!r}")


def temporal_join(facts: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]] | Sequence[str],
                  at: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
                  how: str = "inner", bucket: str | None = "year",
                  horizon: Column | dt.date | None = None, since: Column | dt.date | None = None,
                  unknown_member: Mapping[str, object] | None = None) -> DataFrame:
    """Join ``facts`` to the ``dim`` version valid at ``facts[at]``.

    ``unknown_member``: values for the named dim columns of facts without a
    valid version, which are then kept (a left join) instead of dropped.

    ``on``: fact/dim key pairs (or shared names). Dim columns other than the
    keys keep their names; rename beforehand to avoid clashes. ``horizon``:
    the latest possible fact date (default: a scalar subquery over ``facts``).
    ``since``: the earliest possible fact date; versions that ended before it
    take no part (default: all do).
    """
    if unknown_member:
        out = temporal_join(facts, dim.withColumn("_found", F.lit(True)), on, at, valid_from, valid_to, "left", bucket, horizon, since)
        missing = F.col("_found").isNull()
        return out.select(*[F.when(missing, F.lit(unknown_member[c])).otherwise(F.col(c)).alias(c)
                            if c in unknown_member else F.col(c) for c in out.columns if c != "_found"])
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    at_col = F.col(at).cast("date")
    if bucket is None:
        cond = [facts[f] == dim[d] for f, d in pairs]
        cond.append(at_col.between(dim[valid_from], dim[valid_to]))
        return facts.join(dim, on=cond, how=how)

    if horizon is None:
        horizon = facts.agg(F.max(at_col).alias("h")).scalar()
    elif not isinstance(horizon, Column):
        horizon = F.lit(horizon)
    vf, vt = F.col(valid_from), F.least(F.col(valid_to), horizon)
    alive = dim.where(F.col(valid_from) <= horizon)
    if since is not None:
        since = since if isinstance(since, Column) else F.lit(since)
        alive, vf = alive.where(F.col(valid_to) >= since), F.greatest(vf, since)
    spread = (alive
              .withColumn("_tb", F.explode(F.sequence(_bucket(vf, bucket), _bucket(vt, bucket)))))
    f = facts.withColumn("_tb", _bucket(at_col, bucket))
    cond = [f[a] == spread[b] for a, b in pairs] + [f["_tb"] == spread["_tb"]]
    cond.append(at_col.between(spread[valid_from], spread[valid_to]))
    return f.join(spread, on=cond, how=how).drop(f["_tb"]).drop(spread["_tb"])


def as_of(dim: DataFrame, date: dt.date | str | Column, valid_from: str = "valid_from",
          valid_to: str = "valid_to") -> DataFrame:
    """Versions valid on ``date`` (inclusive interval)."""
    if isinstance(date, str):
        date = dt.date.fromisoformat(date)
    d = date if isinstance(date, Column) else F.lit(date)
    return dim.where(d.between(F.col(valid_from), F.col(valid_to)))
