"""Structured Streaming jobs that fill the stream sink tables.

events (file source here; Kafka in deployment) -> processed events (append),
hourly counts per host [and referrer] (1-hour windows), sessions per
ip/host [and referrer] (session windows). Aggregations run in append mode
behind a watermark, so state is dropped once a window can no longer change
and the sink is a plain exactly-once Parquet file sink with its own
checkpoint in the shared folder. When a bounded run has ended, the windows that
it still held open are read from its state store. ``run_keyed`` keeps a table up
to date instead: update mode, each batch upserted on the key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.functions.pgcompat import wall_clock
from snapfold.operators import web
from snapfold.session import file_system, scratch_path
from snapfold.sources import sinks
from snapfold.sources.fixtures import events_view, processed_view


def processed_events(events_stream: DataFrame, pages: DataFrame, nation: DataFrame) -> DataFrame:
    """Row-wise ingest: device, host, referrer, ip and geodata per event
    (stream-static joins), in the sink's column order."""
    return processed_view(events_view(events_stream, pages, nation))


def hourly_counts(ev_stream: DataFrame, keys: list[str], delay: str = web.WATERMARK_DELAY) -> DataFrame:
    wm = ev_stream.withColumn("event_time", web.event_ts()).withWatermark("event_time", delay)
    return web.hourly_counts(wm, keys)


def session_counts(ev_stream: DataFrame, keys: list[str], gap: str = web.SESSION_GAP,
                   delay: str = web.WATERMARK_DELAY) -> DataFrame:
    wm = ev_stream.withColumn("event_time", web.event_ts()).withWatermark("event_time", delay)
    return web.sessions(wm, keys, gap)


CHECKPOINT = "-checkpoint"      # after the sink's path
BATCHES = "-batches"            # after a keyed sink's path: one empty file for each batch applied


def _started(writer, path: str, available_now: bool, processing_time: str | None):
    writer = writer.option("checkpointLocation", path + CHECKPOINT)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time or "1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def run_to_parquet(spark: SparkSession, stream: DataFrame, name: str, available_now: bool = True,
                   processing_time: str | None = None, path: str | None = None):
    """Start ``stream`` into a Parquet sink under the shared folder; with
    ``available_now`` process what is there and stop. ``path``: of an earlier run, whose
    checkpoint it goes on from. Returns (query, path)."""
    path = path or scratch_path(spark, name)
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return _started(writer, path, available_now, processing_time), path


# ---- what a bounded run still holds

def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame | None:
    """(key, value, partition_id): the rows of a stateful operator as of the last batch that
    its query committed, read with Spark's state source; None before any batch."""
    if not sinks.table_exists(spark, f"{checkpoint}/state/{operator}"):
        return None
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def open_hours(state: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``hourly_counts`` whose hour has not ended."""
    return state.select(wall_clock("key.window.start").alias("event_hour"), *[F.col(f"key.{k}") for k in keys],
                        F.col("value.count").alias("num_hits"))


def open_sessions(state: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``session_counts`` whose session has not ended."""
    return state.select(wall_clock("value.session_window.start").alias("session_start"),
                        wall_clock("value.session_window.end").alias("session_end"),
                        *[F.col(f"value.{k}") for k in keys], F.col("value.count").alias("num_hits")) \
        .select(web.to_millis("session_start"), web.to_millis("session_end"), *keys, "num_hits")


def complete(spark: SparkSession, stream: DataFrame, path: str, windows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of a bounded run that has ended: those in its sink, and the windows still
    open. A stream in append mode holds back every window that may change; once the source
    is known to be complete these are final too. They come from the run's own state, in
    which a window stands until the batch that writes it to the sink takes it out."""
    closed = spark.read.schema(stream.schema).parquet(path)
    state = state_rows(spark, path + CHECKPOINT)
    return closed if state is None else closed.unionByName(windows(state))


# ---- keyed sink

def upsert_batch(path: str, keys: list[str], partition_by: list[str]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: each batch upserted on ``keys`` into the table at ``path``, of
    which only the partitions that it touches are read and replaced. A batch is computed
    once, to a stored copy. Once applied it leaves its number beside the table, and a batch
    whose number is there has no effect; one that failed half way is applied anew, with the
    same rows by the checkpoint's log."""
    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mark = f"{path}{BATCHES}/{number}"
        if sinks.table_exists(spark, mark):
            return
        sinks.through_copy(batch, "batch", lambda rows: sinks.upsert(spark, rows, path, keys, partition_by))
        fs, hp = file_system(spark, mark)
        fs.create(hp, True).close()
    return apply


def run_keyed(spark: SparkSession, stream: DataFrame, name: str, keys: list[str], partition_by: list[str],
              available_now: bool = True, processing_time: str | None = None, path: str | None = None):
    """Start ``stream`` in update mode into a table with a row per key, kept up to date
    (``upsert_batch``): windows still open are in it with their counts so far. ``path``: of
    an earlier run, whose table and checkpoint it goes on from. Returns (query, path)."""
    path = path or scratch_path(spark, name)
    writer = stream.writeStream.outputMode("update").foreachBatch(upsert_batch(path, keys, partition_by))
    return _started(writer, path, available_now, processing_time), path
