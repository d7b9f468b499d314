"""Joins of data back to a per-key summary in which NULL keys meet NULL keys.

``a = b`` is not true for NULLs, so a plain equi-join back to a grouped result
loses the rows of the NULL group. Inside a struct NULLs compare as equal, so
the keys are joined as one struct: still an equi-join (hash or sort-merge, and
split by adaptive execution), with no extra condition per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "__same_key"


def key_of(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])


def same_key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on ``keys`` (in both, same types), which come from ``left``.

    For a full outer join the keys come from whichever side has the row.
    """
    rest = [F.col(c) for c in right.columns if c not in keys]
    out = left.withColumn(KEY, key_of(keys)).join(right.select(key_of(keys).alias(KEY), *rest), KEY, how)
    if how in ("full", "full_outer", "outer"):
        out = out.select(*[F.col(f"{KEY}.k{keys.index(c)}").alias(c) if c in keys else F.col(c) for c in out.columns])
    return out.drop(KEY)
