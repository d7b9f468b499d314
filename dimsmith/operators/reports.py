"""Rollup reports with subtotal labels.

``rollup_with_totals`` groups WITH ROLLUP and labels the subtotal rows with
``'Total'`` using ``grouping()`` — never ``coalesce(key, 'Total')``, which
would also relabel real NULL keys. Aggregation is a hash aggregate over an
Expand, with partial aggregation before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL_LABEL = "Total"


def rollup_with_totals(df: DataFrame, keys: Sequence[tuple[str, str]] | Sequence[str],
                       aggs: Sequence[Column], label: str = TOTAL_LABEL,
                       sort: bool = True) -> DataFrame:
    """``keys``: (input column, output name) pairs or names; ``aggs``: aliased."""
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in keys]
    grouped = df.rollup(*[F.col(src) for src, _ in pairs]).agg(
        *aggs, *[F.grouping(src).alias(f"_g{i}") for i, (src, _) in enumerate(pairs)])
    labelled = grouped.select(
        *[F.when(F.col(f"_g{i}") == 1, F.lit(label)).otherwise(F.col(src).cast("string")).alias(out)
          for i, (src, out) in enumerate(pairs)],
        *[F.col(a) for a in grouped.columns if a not in {s for s, _ in pairs} and not a.startswith("_g")],
        *[F.col(f"_g{i}") for i in range(len(pairs))])
    if sort:
        order = []
        for i, (_, out) in enumerate(pairs):
            order += [F.col(f"_g{i}"), F.col(out)]
        labelled = labelled.orderBy(*order)
    return labelled.drop(*[f"_g{i}" for i in range(len(pairs))])
