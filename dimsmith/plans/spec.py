"""Metadata-driven graphs: one YAML document describes every table.

    tables:
      <Entity>:
        bronze: {kind: table|view, format: csv, options: {...}, folder: name (optional)}
        silver:
          kind: table|view
          expect: {name: predicate}          # warn
          expect_or_drop: {name: predicate}
          expect_or_fail: {name: predicate}
          cdc: {scd_type: 1|2, keys: [...], sequence_by: col | [col, tiebreak...],
                column_list: [...] | except_column_list: [...], buckets: N (optional)}

Names and paths are derived: ``Bronze_<Entity>`` reads new files from
``<landed_root>/<format>/<Entity>`` (plus a ``source_filename`` column; entities
may share a ``folder`` and pick files by ``pathGlobFilter``) into
``<lake_root>/Bronze_<Entity>``; ``Silver_<Entity>`` streams from the bronze
dataset into ``<lake_root>/Silver_<Entity>``. A comment is derived from layer and
entity unless given. A bronze block alone is allowed. Unknown keys are rejected
rather than ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

import yaml
from pyspark.sql import SparkSession

from dimsmith.operators.cdc import ChangeSpec
from dimsmith.plans.graph import TableGraph

_ENTITY = {"bronze", "silver"}
_BRONZE = {"kind", "format", "options", "folder", "comment"}
_SILVER = {"kind", "expect", "expect_or_drop", "expect_or_fail", "cdc", "comment"}
_CDC = {"scd_type", "keys", "sequence_by", "column_list", "except_column_list", "where",
        "ignore_null_updates", "apply_as_deletes", "apply_as_truncates", "buckets"}
_TYPES = {"table", "view"}


class SpecError(ValueError):
    pass


def _check(block: Mapping, allowed: set[str], where: str) -> None:
    if not isinstance(block, Mapping):
        raise SpecError(f"{where} must be a mapping")
    extra = set(block) - allowed
    if extra:
        raise SpecError(f"{where}: unknown keys {sorted(extra)}")


def load_spec(text: str) -> dict:
    doc = yaml.safe_load(text)
    _check(doc, {"tables"}, "document")
    tables = doc.get("tables") or {}
    for entity, blocks in tables.items():
        _check(blocks, _ENTITY, f"tables.{entity}")
        if "bronze" not in blocks:
            raise SpecError(f"tables.{entity}: a silver block needs a bronze block")
        b = blocks["bronze"]
        _check(b, _BRONZE, f"tables.{entity}.bronze")
        if b.get("kind", "table") not in _TYPES or "format" not in b:
            raise SpecError(f"tables.{entity}.bronze needs kind table|view and format")
        s = blocks.get("silver")
        if s is not None:
            _check(s or {}, _SILVER, f"tables.{entity}.silver")
            kind = (s or {}).get("kind", "table")
            if kind not in _TYPES:
                raise SpecError(f"tables.{entity}.silver.kind must be table or view")
            cdc = (s or {}).get("cdc")
            if cdc is not None:
                _check(cdc, _CDC, f"tables.{entity}.silver.cdc")
                if kind != "table":
                    raise SpecError(f"tables.{entity}: change-data silver must be a table")
                for k in ("scd_type", "keys", "sequence_by"):
                    if k not in cdc:
                        raise SpecError(f"tables.{entity}.silver.cdc needs {k}")
    return doc


def _change_spec(cdc: Mapping) -> ChangeSpec:
    seq = cdc["sequence_by"]
    seq_list = [seq] if isinstance(seq, str) else list(seq)
    return ChangeSpec(keys=list(cdc["keys"]), sequence_by=seq_list[0], tiebreak=seq_list[1:],
                      stored_as_scd_type=int(cdc["scd_type"]),
                      columns=cdc.get("column_list"), except_columns=cdc.get("except_column_list"),
                      where=cdc.get("where"), ignore_null_updates=bool(cdc.get("ignore_null_updates")),
                      apply_as_deletes=cdc.get("apply_as_deletes"),
                      apply_as_truncates=cdc.get("apply_as_truncates"))


def build_graph(spark: SparkSession, doc: Mapping, landed_root: str, lake_root: str,
                graph: TableGraph | None = None) -> TableGraph:
    g = graph or TableGraph(spark, lake_root)
    for entity, blocks in doc["tables"].items():
        b = blocks["bronze"]
        bronze, fmt, opts = f"Bronze_{entity}", b["format"], dict(b.get("options") or {})
        landed = f"{landed_root.rstrip('/')}/{fmt}/{b.get('folder', entity)}"
        note = b.get("comment", f"{entity}: new files as they land")

        def read_landed(ctx, landed=landed, fmt=fmt, opts=opts):
            return ctx.read_files(landed, fmt, opts)

        props = {"layer": "bronze"}
        if b.get("kind", "table") == "view":
            g.view(name=bronze, comment=note)(read_landed)
        else:
            g.table(name=bronze, comment=note, path=f"{lake_root}/{bronze}", properties=props)(read_landed)

        s = blocks.get("silver")
        if s is None:
            continue
        s = s or {}
        silver = f"Silver_{entity}"
        note = s.get("comment", f"{entity}: refined")
        if s.get("cdc"):
            g.apply_changes(silver, source=bronze, spec=_change_spec(s["cdc"]),
                            path=f"{lake_root}/{silver}", properties={"layer": "silver"}, comment=note,
                            buckets=s["cdc"].get("buckets"))
            continue

        def read_bronze(ctx, bronze=bronze):
            return ctx.read_stream(bronze)

        rules = dict(expect=s.get("expect"), expect_or_drop=s.get("expect_or_drop"),
                     expect_or_fail=s.get("expect_or_fail"))
        if s.get("kind", "table") == "view":
            g.view(name=silver, comment=note, **rules)(read_bronze)
        else:
            g.table(name=silver, path=f"{lake_root}/{silver}", comment=note,
                    properties={"layer": "silver"}, **rules)(read_bronze)
    return g
