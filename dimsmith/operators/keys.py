"""Surrogate and durable key assignment (IDENTITY / SEQUENCE equivalents).

Both are global numberings built on ``global_rank`` (range partitions + per
partition offsets), never a single-partition ``row_number() over ()``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.operators.ordered import global_rank
from dimsmith.operators.same_key import same_key_join


def assign_durable_keys(dim: DataFrame, business_keys: Sequence[str], out: str = "dk",
                        start: int | Column = 0) -> DataFrame:
    """One int per distinct business key (ordered by the key), on every version.

    ``start`` is the current maximum durable key (new members continue it).
    """
    keys = list(business_keys)
    numbering = global_rank(dim.select(*keys), keys, out="_n", method="dense_rank", attach=False)
    start_col = start if isinstance(start, Column) else F.lit(start)
    numbering = numbering.select(*keys, (start_col + F.col("_n")).cast("bigint").alias(out))
    return same_key_join(dim, numbering, keys)


def assign_surrogate_keys(df: DataFrame, load_order: Sequence[str], out: str = "sk",
                          start: int | Column = 0) -> DataFrame:
    """Row numbers in load order (``load_order`` must be unique), offset by ``start``."""
    start_col = start if isinstance(start, Column) else F.lit(start)
    ranked = global_rank(df, list(load_order), out="_n", method="row_number")
    return ranked.withColumn(out, (start_col + F.col("_n")).cast("bigint")).drop("_n")
