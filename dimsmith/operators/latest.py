"""Latest row per key.

``keep='one'``: ``max(struct(order…, payload…))`` per key. A struct buffer makes
it a sort aggregate with a partial (map-side) step: each input partition is
sorted once and a key holding a third of the rows is reduced to one row per
partition before the shuffle — no window, no single-task sort of a hot key.

``keep='all'``: every row tied at the maximum. The per-key maximum is computed
the same way, then joined back on (key, max order); the joined side has one
row per key and Catalyst/AQE choose broadcast or a skew-split sort-merge join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimsmith.operators.same_key import same_key_join


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              keep: str = "one") -> DataFrame:
    keys, order = list(keys), list(order)
    if keep == "one":
        rest = [c for c in df.columns if c not in keys and c not in order]
        best = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_best")
        return (df.groupBy(*keys).agg(best)
                .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order + rest])
                .select(*df.columns))
    if keep == "all":
        top = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in order])).alias("_top"))
        top = top.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in order])
        return same_key_join(df, top, keys + order, "left_semi")
    raise ValueError(f"keep must be 'one' or 'all', not {keep!r}")
