"""Declarative table graph: decorated DataFrame functions become tables/views.

    g = TableGraph(spark, root)

    @g.table(comment="raw orders", properties={"layer": "bronze"})
    def bronze_orders(ctx):
        return ctx.read_files(landed, "csv", {"header": True, "inferSchema": True})

    @g.table(expect={"positive": "o_totalprice > 0"}, expect_or_drop={...})
    def silver_orders(ctx):
        return ctx.read_stream("bronze_orders")

    g.apply_changes("silver_customer", source="bronze_customer", spec=ChangeSpec(...))
    g.run()

* A function returning a streaming DataFrame is a *streaming table*
  (append-only, exactly-once file sink, own checkpoint, triggered run); a
  batch DataFrame makes a *full-refresh table* (new complete snapshot each
  run); ``view`` results exist only inside the run.
* Dependencies are the names a function reads; they are materialised first
  (cycles are rejected). A streaming read of a full-refresh table is
  rejected: a stream needs an append-only source.
* Expectations are observed while the table is written; per-run metrics go to
  the event log (``root/system/events``) as create_update / flow_progress rows.
* ``run(full_refresh=[…])`` starts those streaming tables over (new checkpoint,
  new output generation, file schemas inferred anew), and with them every
  dataset that streams from one of them, directly or through a view.
* SQL bodies name other datasets like tables; the author lists which of them
  are read and which streamed, and Spark resolves the text as it is.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimsmith.operators.cdc import ChangeSpec
from dimsmith.plans.eventlog import log_rows
from dimsmith.plans.quality import (Expectation, apply_actions, expectations_from, metric_columns,
                                    metrics_of)
from dimsmith.sinks.files import _fs, append, latest_snapshot_path, write_snapshot
from dimsmith.sources.files import read_file_stream
from dimsmith.streaming.apply_changes import apply_changes_stream, read_target
from dimsmith.streaming.progress import STATE, ProgressTotals


@dataclass
class Dataset:
    name: str
    fn: Callable | None
    kind: str  # 'table' | 'view' | 'changes'
    comment: str | None = None
    path: str | None = None
    properties: dict = field(default_factory=dict)
    rules: list[Expectation] = field(default_factory=list)
    source: str | None = None
    spec: ChangeSpec | None = None
    streaming: bool | None = None
    schema: object | None = None
    buckets: int | None = None


class GraphError(ValueError):
    pass


class _Context:
    def __init__(self, graph: "TableGraph", reader: str):
        self.graph, self.reader = graph, reader
        self.spark = graph.spark

    def read(self, name: str) -> DataFrame:
        return self.graph._read(name, stream=False, reader=self.reader)

    def read_stream(self, name: str) -> DataFrame:
        return self.graph._read(name, stream=True, reader=self.reader)

    def read_files(self, path: str, fmt: str = "csv", options: Mapping | None = None,
                   provenance: str | None = "source_filename", **reader_options) -> DataFrame:
        opts = dict(options or {})
        opts.update(reader_options)
        if "delimiter" in opts:
            opts["sep"] = opts.pop("delimiter")
        schema_path = f"{self.graph.root}/_schemas/{self.reader}.json"
        return read_file_stream(self.spark, path, fmt, opts, schema_path=schema_path,
                                provenance=provenance)

    def sql(self, query: str, reads: Iterable[str] = (), streams: Iterable[str] = ()) -> DataFrame:
        """SQL body over the datasets that it lists: each is a view of its own
        name, one in ``streams`` a streaming view; Spark resolves the names.

        A dataset that is read and streamed has its streaming view under
        ``<name>__stream``.
        """
        reads, streams = list(reads), list(streams)
        for name in streams:
            self.read_stream(name).createOrReplaceTempView(f"{name}__stream" if name in reads else name)
        for name in reads:
            self.read(name).createOrReplaceTempView(name)
        return self.spark.sql(query)


class TableGraph:
    def __init__(self, spark: SparkSession, root: str, name: str = "graph"):
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self._datasets: dict[str, Dataset] = {}
        self._done: dict[str, DataFrame | None] = {}
        self._resolving: set[str] = set()
        self._metrics: dict[str, dict] = {}
        self._full_refresh: set[str] = set()
        self._view_tags: dict[str, str] = {}
        self._view_counts: dict[str, Observation] = {}
        self._readers: dict[str, set[str]] = {}
        self._totals: ProgressTotals | None = None
        self._continuous: str | None = None
        self._running: dict = {}

    # ------------------------------------------------------------ declare
    def _register(self, ds: Dataset) -> None:
        if ds.name in self._datasets:
            raise GraphError(f"dataset {ds.name} defined twice")
        self._datasets[ds.name] = ds

    def table(self, name: str | None = None, comment: str | None = None, path: str | None = None,
              properties: Mapping | None = None, expect: Mapping | None = None,
              expect_or_drop: Mapping | None = None, expect_or_fail: Mapping | None = None):
        def deco(fn):
            self._register(Dataset(name or fn.__name__, fn, "table", comment, path,
                                   dict(properties or {}),
                                   expectations_from(expect, expect_or_drop, expect_or_fail)))
            return fn
        return deco

    def view(self, name: str | None = None, comment: str | None = None,
             expect: Mapping | None = None, expect_or_drop: Mapping | None = None,
             expect_or_fail: Mapping | None = None):
        def deco(fn):
            self._register(Dataset(name or fn.__name__, fn, "view", comment,
                                   rules=expectations_from(expect, expect_or_drop, expect_or_fail)))
            return fn
        return deco

    def sql_table(self, name: str, query: str, reads: Iterable[str] = (), streams: Iterable[str] = (), **kwargs) -> None:
        self.table(name=name, **kwargs)(lambda ctx: ctx.sql(query, reads, streams))

    def apply_changes(self, target: str, source: str, spec: ChangeSpec,
                      comment: str | None = None, path: str | None = None,
                      properties: Mapping | None = None, buckets: int | None = None) -> None:
        """Change-data target maintained from a streaming source; ``buckets``
        deals its snapshots to so many files by key."""
        self._register(Dataset(target, None, "changes", comment, path, dict(properties or {}),
                               source=source, spec=spec, streaming=True, buckets=buckets))

    # ------------------------------------------------------------ paths
    def _generation(self, name: str) -> int:
        fs, p, _ = _fs(self.spark, f"{self.root}/_checkpoints/{name}")
        if not fs.exists(p):
            return 0
        gens = [int(s.getPath().getName()[4:]) for s in fs.listStatus(p)
                if s.getPath().getName().startswith("gen=")]
        return max(gens) if gens else 0

    def table_path(self, name: str) -> str:
        ds = self._datasets[name]
        base = ds.path or f"{self.root}/tables/{name}"
        return f"{base}/gen={self._generation(name)}"

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}/gen={self._generation(name)}"

    # ------------------------------------------------------------ read
    def _read(self, name: str, stream: bool, reader: str) -> DataFrame:
        if name not in self._datasets:
            raise GraphError(f"{reader} reads unknown dataset {name}")
        ds = self._datasets[name]
        self._readers.setdefault(name, set()).add(reader)
        if ds.kind == "view":
            df = self._materialise(name)
            if name in self._full_refresh:
                self._full_refresh.add(reader)
            if stream and not df.isStreaming:
                raise GraphError(f"{reader} streams from view {name}, which is not a stream")
            return df
        self._materialise(name)
        if ds.kind == "changes":
            if stream:
                raise GraphError(f"{reader}: an apply-changes target is not append-only")
            return read_target(self.spark, self.table_path(name), ds.spec)
        if stream:
            if not ds.streaming:
                raise GraphError(
                    f"{reader} streams from full-refresh table {name}; a stream needs an "
                    "append-only source (declare the source as a streaming table)")
            if name in self._full_refresh:      # its files were replaced
                self._full_refresh.add(reader)
            schema = ds.schema if ds.schema is not None else self._schema(name)
            return self.spark.readStream.schema(schema).parquet(self.table_path(name))
        if ds.streaming:
            return self.spark.read.parquet(self.table_path(name))
        path = latest_snapshot_path(self.spark, self.table_path(name))
        return self.spark.read.parquet(path)

    def _schema(self, name: str):
        return self.spark.read.parquet(self.table_path(name)).schema

    # ------------------------------------------------------------ run
    def _materialise(self, name: str) -> DataFrame | None:
        if name in self._done:
            return self._done[name]
        if name in self._resolving:
            raise GraphError(f"cycle through {name}")
        self._resolving.add(name)
        ds = self._datasets[name]
        try:
            if ds.kind == "changes":
                out = self._run_changes(ds)
            else:
                if name in self._full_refresh:
                    self._drop_schema(name)
                df = ds.fn(_Context(self, name))
                ds.streaming = df.isStreaming
                if ds.kind == "view":
                    out = self._view_rules(ds, df) if ds.rules else df
                elif df.isStreaming:
                    out = self._run_stream(ds, df)
                else:
                    out = self._run_batch(ds, df)
        finally:
            self._resolving.discard(name)
        if ds.kind != "view":
            self._write_metadata(ds)
        self._done[name] = out
        return out

    def _view_rules(self, ds: Dataset, df: DataFrame) -> DataFrame:
        """A view's rules are counted while the first table that reads it is written."""
        tag = f"v_{ds.name}_{uuid.uuid4().hex[:8]}"
        if df.isStreaming:
            self._view_tags[tag] = ds.name
            return apply_actions(df.observe(tag, *metric_columns(ds.rules)), ds.rules, ds.name)
        self._view_counts[ds.name] = counts = Observation(tag)
        return apply_actions(df.observe(counts, *metric_columns(ds.rules)), ds.rules, ds.name)

    def _log_views(self, totals: Mapping[str, Mapping[str, int]]) -> None:
        for tag, values in totals.items():
            view = self._view_tags.get(tag)
            if view and view not in self._metrics and values:
                self._metrics[view] = metrics_of(values, self._datasets[view].rules, view)

    def _is_written(self, name: str) -> bool:
        """Whether a table of this run has read the view, directly or through views."""
        return any(r in self._datasets and (self._datasets[r].kind != "view" or self._is_written(r))
                   for r in self._readers.get(name, ()))

    def _run_stream(self, ds: Dataset, df: DataFrame) -> None:
        if ds.name in self._full_refresh:
            self._bump_generation(ds.name)
        tag = f"q_{ds.name}_{uuid.uuid4().hex[:8]}"
        out = df
        if ds.rules:
            out = apply_actions(df.observe(tag, *metric_columns(ds.rules)), ds.rules, ds.name)
        ds.schema = out.schema
        out = out.observe(f"{tag}_out", F.count(F.lit(1)).alias("rows"))
        writer = (out.writeStream.format("parquet").outputMode("append")
                  .option("path", self.table_path(ds.name))
                  .option("checkpointLocation", self._checkpoint(ds.name)))
        if self._continuous:
            self._running[ds.name] = writer.trigger(processingTime=self._continuous).start()
            return None
        totals = self._totals.finish(writer.trigger(availableNow=True).start())
        rows = totals.pop(f"{tag}_out", {}).get("rows", 0)
        late = totals.pop(STATE, None)
        self._metrics[ds.name] = metrics_of(totals.pop(tag, None), ds.rules, ds.name, rows)
        if late is not None:
            self._metrics[ds.name]["metrics"]["num_late_rows"] = late["late_rows"]
        self._log_views(totals)
        return None

    def _run_batch(self, ds: Dataset, df: DataFrame) -> None:
        counts = Observation(f"q_{ds.name}_{uuid.uuid4().hex[:8]}")
        out = apply_actions(df.observe(counts, *metric_columns(ds.rules)), ds.rules, ds.name)
        write_snapshot(out, self.table_path(ds.name))
        self._metrics[ds.name] = metrics_of(counts.get, ds.rules, ds.name)
        return None

    def _run_changes(self, ds: Dataset) -> None:
        src = self._read(ds.source, stream=True, reader=ds.name)
        if ds.name in self._full_refresh:
            self._bump_generation(ds.name)
        path = self.table_path(ds.name)
        counts: list[int] = []
        q = apply_changes_stream(src, ds.spec, path, self._checkpoint(ds.name),
                                 available_now=not self._continuous,
                                 processing_time=self._continuous or None,
                                 buckets=ds.buckets, on_batch=counts.append)
        if self._continuous:
            self._running[ds.name] = q
            return None
        self._log_views(self._totals.finish(q))
        self._metrics[ds.name] = {"metrics": {"num_output_rows": sum(counts)}}
        return None

    def _drop_schema(self, name: str) -> None:
        fs, p, _ = _fs(self.spark, f"{self.root}/_schemas/{name}.json")
        if fs.exists(p):
            fs.delete(p, True)

    def _write_metadata(self, ds: Dataset) -> None:
        """Table metadata (comment, properties such as the layer, kind, path)
        as ``_table.json`` beside the data; readers skip '_' files."""
        meta = {"name": ds.name, "kind": ds.kind, "streaming": bool(ds.streaming),
                "comment": ds.comment, "properties": ds.properties,
                "path": self.table_path(ds.name),
                "expectations": [r.__dict__ for r in ds.rules]}
        fs, p, _ = _fs(self.spark, f"{self.table_path(ds.name)}/_table.json")
        out = fs.create(p, True)
        try:
            out.write(bytearray(json.dumps(meta, default=str).encode("utf-8")))
        finally:
            out.close()

    def table_metadata(self, name: str) -> dict:
        fs, p, jvm = _fs(self.spark, f"{self.table_path(name)}/_table.json")
        stream = fs.open(p)
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _bump_generation(self, name: str) -> None:
        gen = self._generation(name)
        fs, _, jvm = _fs(self.spark, self.root)
        cp = f"{self.root}/_checkpoints/{name}/gen={gen}"
        fs_cp, p_cp, _ = _fs(self.spark, cp)
        if fs_cp.exists(p_cp):
            fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{self.root}/_checkpoints/{name}/gen={gen + 1}"))

    def validate(self) -> None:
        """Static checks before running: every source exists."""
        for ds in self._datasets.values():
            if ds.kind == "changes" and ds.source not in self._datasets:
                raise GraphError(f"{ds.name} applies changes from unknown {ds.source}")

    def start(self, processing_time: str = "1 minute") -> dict:
        """Continuous mode: start every streaming table / change flow with a
        processing-time trigger (full-refresh tables are built once first);
        returns {name: StreamingQuery}. Stop them with ``stop()``."""
        self.validate()
        self._done.clear()
        self._running, self._full_refresh = {}, set()
        self._continuous = processing_time
        try:
            for name in self._datasets:
                self._materialise(name)
        finally:
            self._continuous = None
        return dict(self._running)

    def stop(self) -> None:
        for q in self._running.values():
            q.stop()
        self._running = {}

    def run(self, full_refresh: Iterable[str] = ()) -> str:
        """Triggered mode: materialise every dataset once (dependencies first),
        each stream processes what has landed and stops; returns the run id."""
        self.validate()
        self._done.clear()
        self._metrics.clear()
        self._full_refresh = set(full_refresh)
        unknown = self._full_refresh - set(self._datasets)
        if unknown:
            raise GraphError(f"full refresh of unknown datasets {sorted(unknown)}")
        update_id = uuid.uuid4().hex
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self._view_tags, self._view_counts, self._readers = {}, {}, {}
        self._totals = ProgressTotals().attach(self.spark)
        try:
            for name in self._datasets:
                self._materialise(name)
        finally:
            self._totals.detach(self.spark)
        for view, counts in self._view_counts.items():
            if self._is_written(view):
                self._metrics[view] = metrics_of(counts.get, self._datasets[view].rules, view)
        append(log_rows(self.spark, update_id, started, self._metrics), self.event_log_path)
        return update_id

    def describe(self) -> DataFrame:
        """One row per dataset: name, kind, comment, properties, path, rules."""
        rows = [(ds.name, ds.kind, ds.comment, {k: str(v) for k, v in ds.properties.items()},
                 None if ds.kind == "view" else self.table_path(ds.name),
                 [f"{r.action}:{r.name}" for r in ds.rules])
                for ds in self._datasets.values()]
        return self.spark.createDataFrame(
            rows, "name string, kind string, comment string, properties map<string,string>, "
                  "path string, expectations array<string>")

    @property
    def event_log_path(self) -> str:
        return f"{self.root}/system/events"

    def event_log(self) -> DataFrame:
        return self.spark.read.parquet(self.event_log_path)

    def read(self, name: str) -> DataFrame:
        """Read a materialised table after a run."""
        return self._read(name, stream=False, reader="<user>")
