"""Data-quality expectations: warn, drop, fail.

A row passes a rule only when the predicate IS TRUE (NULL is a violation).
All rules are evaluated on the query's output before any row is dropped.

* ``apply_expectations`` returns the filtered DataFrame and an
  ``Observation`` whose metrics (passed/failed per rule, dropped rows, output
  rows) are filled when the result is written — counted in the same pass as
  the write, on batch and on streaming micro-batches alike.
* ``fail`` rules wrap the row in ``raise_error`` so the job aborts before its
  sink commits.
* ``quality_report`` is the same per-rule count as a distributed aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}")

    @property
    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expectations_from(expect: Mapping[str, str] | None = None,
                      expect_or_drop: Mapping[str, str] | None = None,
                      expect_or_fail: Mapping[str, str] | None = None) -> list[Expectation]:
    """``{name: predicate}`` sets for the three modes, in that order."""
    out: list[Expectation] = []
    for action, rules in (("warn", expect), ("drop", expect_or_drop), ("fail", expect_or_fail)):
        for name, pred in (rules or {}).items():
            out.append(Expectation(name, pred, action))
    return out


def metric_columns(rules: list[Expectation]) -> list[Column]:
    cols = [F.count(F.lit(1)).alias("input_rows")]
    for i, r in enumerate(rules):
        cols.append(F.count_if(r.passes).alias(f"passed_{i}"))
        cols.append(F.count_if(~r.passes).alias(f"failed_{i}"))
    drops = [r for r in rules if r.action == "drop"]
    if drops:
        kept = F.lit(True)
        for r in drops:
            kept = kept & r.passes
        cols.append(F.count_if(~kept).alias("dropped_records"))
    else:
        cols.append(F.lit(0).cast("bigint").alias("dropped_records"))
    return cols


def apply_actions(df: DataFrame, rules: Iterable[Expectation], dataset: str) -> DataFrame:
    """Abort on violations of ``fail`` rules, drop those of ``drop`` rules."""
    rules = list(rules)
    for r in rules:
        if r.action == "fail":
            msg = F.lit(f"expectation {r.name} failed on {dataset}: {r.predicate}")
            df = df.where(F.when(r.passes, F.lit(True)).otherwise(F.raise_error(msg)))
    for r in rules:
        if r.action == "drop":
            df = df.where(r.passes)
    return df


def apply_expectations(df: DataFrame, rules: Iterable[Expectation], dataset: str
                       ) -> tuple[DataFrame, Observation | None]:
    """Batch form: the filtered DataFrame and the Observation that its first action fills."""
    rules = list(rules)
    if not rules:
        return df, None
    obs = Observation(f"quality_{dataset}")
    return apply_actions(df.observe(obs, *metric_columns(rules)), rules, dataset), obs


def metrics_of(values: Mapping[str, int] | None, rules: Iterable[Expectation], dataset: str,
               output_rows: int | None = None) -> dict:
    """Observed metric values (``Observation.get`` or summed stream batches)
    -> the event-log ``flow_progress`` shape."""
    rules = list(rules)
    if not values:
        return {"metrics": {"num_output_rows": output_rows}} if output_rows is not None else {}
    m = values
    exp = [{"name": r.name, "dataset": dataset, "passed_records": int(m[f"passed_{i}"]),
            "failed_records": int(m[f"failed_{i}"])} for i, r in enumerate(rules)]
    rows = int(m["input_rows"]) - int(m["dropped_records"])
    if not rules:
        return {"metrics": {"num_output_rows": rows if output_rows is None else output_rows}}
    return {"metrics": {"num_output_rows": rows if output_rows is None else output_rows},
            "data_quality": {"dropped_records": int(m["dropped_records"]), "expectations": exp}}


def quality_report(df: DataFrame, rules: Iterable[Expectation], dataset: str) -> DataFrame:
    """(dataset, expectation, passed_records, failed_records) — one aggregate pass."""
    rules = list(rules)
    agg = df.agg(*metric_columns(rules))
    stacked = F.explode(F.array(*[
        F.struct(F.lit(dataset).alias("dataset"), F.lit(r.name).alias("expectation"),
                 F.col(f"passed_{i}").alias("passed_records"),
                 F.col(f"failed_{i}").alias("failed_records"))
        for i, r in enumerate(rules)]))
    return agg.select(stacked.alias("r")).select("r.*")
