"""Streaming jobs run to completion (``availableNow``) into Parquet sinks and
read back. Append mode emits a window once the watermark passes its end; the
windows still open at the end of the bounded source are added from the run's
state, so each report equals the full batch result. The keyed sink needs none: its
table has every window, upserted batch by batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapfold.plans.oracle import oracle
from snapfold.plans.q_web import GAP_MINUTES, SESSION_KEYS, SESSION_SOURCE_KEYS, sessions_sql
from snapfold.plans.registry import query
from snapfold.sources.tables import event_stream, read_table
from snapfold.streaming import jobs

DELAY_MINUTES = 10
DELAY = f"{DELAY_MINUTES} minutes"


def _fx_stream(spark, sf_dir):
    from snapfold.sources.fixtures import events_view
    return events_view(event_stream(spark, sf_dir), read_table(spark, sf_dir, "pages"),
                       read_table(spark, sf_dir, "nation"))


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    stream = jobs.processed_events(event_stream(spark, sf_dir), read_table(spark, sf_dir, "pages"),
                                   read_table(spark, sf_dir, "nation"))
    _, path = jobs.run_to_parquet(spark, stream, "processed_events")
    return spark.read.parquet(path)


oracle("stream_ingest", "SELECT * FROM fx_processed_events")


def _hourly(keys, name):
    def run(spark, sf_dir):
        stream = jobs.hourly_counts(_fx_stream(spark, sf_dir), keys, DELAY)
        _, path = jobs.run_to_parquet(spark, stream, name)
        return jobs.complete(spark, stream, path, lambda state: jobs.open_hours(state, keys))
    return run


query("stream_hourly")(_hourly(["host"], "processed_events_aggregated"))
query("stream_hourly_source")(_hourly(["host", "referrer"], "processed_events_aggregated_source"))


@query("stream_hourly_upsert")
def stream_hourly_upsert(spark, sf_dir):
    """The hourly table of a keyed sink: (event_hour, host) is its key, a day a partition."""
    stream = jobs.hourly_counts(_fx_stream(spark, sf_dir), ["host"], DELAY) \
        .withColumn("event_date", F.to_date("event_hour"))
    _, path = jobs.run_keyed(spark, stream, "hourly_upsert", ["event_date", "event_hour", "host"], ["event_date"])
    return spark.read.schema(stream.schema).parquet(path).select("event_hour", "host", "num_hits")


def _hourly_sql(keys):
    k = ", ".join(keys)
    return f"""SELECT date_trunc('hour', event_time) AS event_hour, {k}, COUNT(*) AS num_hits
FROM fx_events WHERE event_time IS NOT NULL GROUP BY date_trunc('hour', event_time), {k}"""


oracle("stream_hourly", _hourly_sql(["host"]))
oracle("stream_hourly_upsert", _hourly_sql(["host"]))
oracle("stream_hourly_source", _hourly_sql(["host", "referrer"]))


def _sessions(keys, name):
    def run(spark, sf_dir):
        stream = jobs.session_counts(_fx_stream(spark, sf_dir), keys, f"{GAP_MINUTES} minutes", DELAY)
        _, path = jobs.run_to_parquet(spark, stream, name)
        return jobs.complete(spark, stream, path, lambda state: jobs.open_sessions(state, keys))
    return run


query("stream_sessions")(_sessions(SESSION_KEYS, "assignment_events_sessions"))
query("stream_sessions_source")(_sessions(SESSION_SOURCE_KEYS, "processed_assignment_events_source_sessions"))


def _sessions_oracle(keys):
    return sessions_sql(keys) + f"SELECT session_start, session_end, {', '.join(keys)}, num_hits FROM sessions"


oracle("stream_sessions", _sessions_oracle(SESSION_KEYS))
oracle("stream_sessions_source", _sessions_oracle(SESSION_SOURCE_KEYS))
