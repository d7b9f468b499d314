"""Totals of observed metrics over every micro-batch of a streaming run.

``query.recentProgress`` keeps only the last reports (100 by default), so a
run with more micro-batches would lose counts. The listener receives every
report in order and adds the observed metrics up per query run, and with them
the rows that stateful operators dropped as late.
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


#: Tag of what stateful operators report: rows that came below the watermark.
STATE = "_state"


class ProgressTotals(StreamingQueryListener):
    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._totals: dict[str, dict] = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def attach(self, spark: SparkSession) -> ProgressTotals:
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._ended[str(event.runId)].clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            mine = self._totals[str(p.runId)]
            for tag, row in (p.observedMetrics or {}).items():
                for name, value in row.asDict().items():
                    mine[tag][name] += int(value or 0)
            for state in p.stateOperators or []:
                mine[STATE]["late_rows"] += int(state.numRowsDroppedByWatermark)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            ended = self._ended[str(event.runId)]
        ended.set()

    def finish(self, query: StreamingQuery, timeout: float = 120.0) -> dict[str, dict[str, int]]:
        """Wait for a triggered query and its last report; {tag: {metric: total}}."""
        query.awaitTermination()
        exc = query.exception()
        if exc is not None:
            raise RuntimeError(str(exc))
        run = str(query.runId)
        with self._lock:
            ended = self._ended[run]
        if not ended.wait(timeout):
            raise RuntimeError(f"no end report of streaming run {run}")
        with self._lock:
            return {tag: dict(m) for tag, m in self._totals.pop(run, {}).items()}
