"""Incremental file ingest and stream joins.

``ingest_files`` lands new files into an append-only parquet table. The file
sink commits through its own metadata log together with the checkpoint, so
each landed file is processed exactly once, also across restarts; a
triggered run (``availableNow``) processes what has landed and stops.

Stream joins:
* inner stream–stream equi-join needs no watermark, but both sides are kept
  in state forever; pass ``watermarks`` to bound it.
* left outer stream–stream join is only defined with watermarks on both
  sides plus an event-time range condition (Spark rejects it otherwise);
  unmatched left rows are emitted once the watermark passes their range.
* stream–static left join re-reads the static side for each micro-batch.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def ingest_files(stream: DataFrame, target: str, checkpoint: str,
                 available_now: bool = True, processing_time: str | None = None,
                 partition_by: Sequence[str] = ()) -> StreamingQuery:
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", target).option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time or "1 minute"))
    return writer.start()


def run_to_end(query: StreamingQuery) -> None:
    """Wait for a triggered query; raise its error, if any. (For counts over a
    run see ``progress.ProgressTotals``: ``recentProgress`` is cut.)"""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(str(exc))


def feed_to_end(query: StreamingQuery, landings: Iterable[Callable[[], None]]) -> None:
    """Land one part of the feeds after the other into a query that stays up
    (``ingest_files(..., available_now=False)``): each part is processed whole
    before the next one lands; then the query is stopped. Raises the query's
    error, if any.

    A stateful query that is started anew for each part reads its state back as
    all changes ever made to it; one that stays up keeps it. It also polls while
    a part lands, so a part must appear at once (``sinks.files.move_folder``):
    the watermark of half a part could make the other half late."""
    try:
        for landing in landings:
            landing()
            query.processAllAvailable()
    finally:
        query.stop()


@contextlib.contextmanager
def without_empty_batches(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started inside run no batch without rows: what a part's
    watermark closes comes out with the next part that has rows, not in a batch
    of its own. The feeds must end with two closing parts: the first one moves
    the watermark past all rows, the second one lets them out."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stream_join(left: DataFrame, right: DataFrame, on: Column | Sequence[str] | str,
                how: str = "inner", watermarks: Mapping[str, tuple[str, str]] | None = None
                ) -> DataFrame:
    """Stream–stream (or stream–static) join. ``watermarks``: {'left'|'right':
    (event_time_column, delay)} applied before joining."""
    wm = dict(watermarks or {})
    if "left" in wm:
        left = left.withWatermark(*wm["left"])
    if "right" in wm:
        right = right.withWatermark(*wm["right"])
    return left.join(right, on=on, how=how)


def dedupe_within(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first row of each key, in bounded state: a key is forgotten ``delay`` after its event time, and
    rows below the watermark are dropped as late (counted by ``progress.ProgressTotals`` and the event log)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
