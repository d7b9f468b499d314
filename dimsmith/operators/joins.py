"""Joins of the inventory (set → parts) ETL, and a join with an explicit hint.

``hinted_join`` sets a join strategy where the caller knows better than the
statistics (``broadcast``, ``merge``, ``shuffle_hash`` …); without a hint
Catalyst and adaptive execution choose by bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.scalars import spare_quantity
from dimsmith.operators.latest import latest_by

def hinted_join(left: DataFrame, right: DataFrame, on: Column | Sequence[str] | str,
                how: str = "inner", hint: str | None = None) -> DataFrame:
    return left.join(right.hint(hint) if hint else right, on, how)


def set_parts(sets: DataFrame, inventories: DataFrame, parts: DataFrame,
              set_key: str, inv_id: str, inv_version: str, part_inv: str,
              keep: str = "one", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sets ⋈ latest inventory version per set ⋈ inventory parts.

    ``keep='one'`` picks one inventory per set (greatest version, then
    ``tiebreak``), ``keep='all'`` keeps every inventory tied at the greatest
    version (the two behaviours of the model). The version must be numeric:
    cast string versions first, or '9' sorts above '10'.
    """
    order = [inv_version, *tiebreak]
    latest = latest_by(inventories, [set_key], order, keep=keep)
    j = sets.join(latest, on=set_key, how="inner")
    return j.join(parts, j[inv_id] == parts[part_inv], how="inner")


def part_totals(set_parts_df: DataFrame, part: str, color: str, quantity: str,
                is_spare: str) -> DataFrame:
    """Total and spare quantity per (part, colour); spare = CASE, not a UDF."""
    q = F.col(quantity)
    return (set_parts_df.groupBy(part, color)
            .agg(F.sum(q).alias("quantity"),
                 F.sum(spare_quantity(is_spare, q)).alias("spare_quantity")))


def build_inventory(set_parts_df: DataFrame, out_dir: str, part: str, color: str,
                    quantity: str, is_spare: str) -> tuple[str, str]:
    """The inventory flow with two sinks sharing one result: the set parts are
    persisted once, written as a plain delimited text table and aggregated
    into part totals written as CSV partitioned by colour; then released.
    Returns (set_parts_path, part_totals_path)."""
    from pyspark import StorageLevel

    from dimsmith.sinks.files import write_partitioned_csv, write_text_table

    shared = set_parts_df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_text_table(shared, f"{out_dir}/set_parts")
        totals = part_totals(shared, part, color, quantity, is_spare)
        write_partitioned_csv(totals, f"{out_dir}/part_totals", color)
    finally:
        shared.unpersist()
    return f"{out_dir}/set_parts", f"{out_dir}/part_totals"
