from __future__ import annotations

import datetime as dt
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from snapfold.plans.registry import load_all
from snapfold.sources.tables import TABLES, table_path
from snapfold.streaming import jobs

T = dt.datetime


def _write(path, rows, mtime):
    pd.DataFrame(rows, columns=["event_time", "host"]).to_parquet(path, index=False, coerce_timestamps="us")
    os.utime(path, (mtime, mtime))


def test_late_row_past_watermark_is_dropped(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    now = time.time()
    _write(src / "a.parquet", [(T(2024, 1, 1, 10, 5), "h"), (T(2024, 1, 1, 11, 5), "h"),
                               (T(2024, 1, 1, 12, 30), "h")], now - 100)
    # batch 1 moves the watermark to 13:50; rows are judged late against the
    # previous batch's watermark, so the 09:30 row of batch 2 meets 12:20
    _write(src / "b.parquet", [(T(2024, 1, 1, 14, 0), "h")], now - 50)
    _write(src / "c.parquet", [(T(2024, 1, 1, 9, 30), "h")], now - 20)
    stream = (spark.readStream.schema("event_time timestamp_ntz, host string")
              .option("maxFilesPerTrigger", 1).parquet(str(src)))
    q, path = jobs.run_to_parquet(spark, jobs.hourly_counts(stream, ["host"], "10 minutes"), "late-test")
    got = sorted((r.event_hour.hour, r.num_hits) for r in spark.read.parquet(path).collect())
    assert got == [(10, 1), (11, 1), (12, 1)]  # 09:00 dropped as late, 14:00 still open
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_sessions_stream_matches_batch_when_closed(spark, tmp_path):
    src = tmp_path / "s"
    src.mkdir()
    rows = [(T(2024, 1, 1, 10, m), "h") for m in (0, 10, 50)] + [(T(2024, 1, 1, 15, 0), "h")]
    _write(src / "a.parquet", rows, time.time() - 10)
    stream = spark.readStream.schema("event_time timestamp_ntz, host string").parquet(str(src))
    q, path = jobs.run_to_parquet(spark, jobs.session_counts(stream, ["host"], "30 minutes", "10 minutes"), "sess-test")
    got = sorted((r.session_start.hour, r.session_start.minute, r.num_hits) for r in spark.read.parquet(path).collect())
    assert got == [(10, 0, 2), (10, 50, 1)]  # the 15:00 session is still open at the end


@pytest.fixture(scope="module")
def folder_dir(tmp_path_factory, sf_dir):
    """The same tables, ``events`` as a folder of three part files."""
    import pyarrow.parquet as pq
    top = tmp_path_factory.mktemp("folder")
    for t in TABLES:
        if t != "events":
            os.symlink(table_path(sf_dir, t), table_path(str(top), t))
    rows = pq.read_table(table_path(sf_dir, "events"))
    (top / "events.parquet").mkdir()
    for k in range(3):
        pq.write_table(rows.slice(k * (len(rows) // 3), len(rows) // 3 if k < 2 else None), top / f"events.parquet/part-{k}.parquet")
    return str(top)


@pytest.mark.parametrize("name", ["stream_ingest", "stream_hourly", "stream_hourly_source", "stream_sessions",
                                  "stream_sessions_source", "stream_hourly_upsert"])
def test_a_folder_gives_the_rows_of_the_file(spark, sf_dir, folder_dir, name):
    got = [sorted(map(str, load_all()[name](spark, d).collect())) for d in (sf_dir, folder_dir)]
    assert got[0] == got[1] and len(got[0]) > 100


def _source(spark, path, one_by_one=True):
    reader = spark.readStream.schema("event_time timestamp_ntz, host string")
    return (reader.option("maxFilesPerTrigger", 1) if one_by_one else reader).parquet(str(path))


def test_open_windows_come_from_the_state(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    _write(src / "a.parquet", [(T(2024, 1, 1, 10, 5), "h"), (T(2024, 1, 1, 11, 5), None)], time.time() - 9)
    _write(src / "b.parquet", [(T(2024, 1, 1, 11, 6), None), (T(2024, 1, 1, 13, 59), "g"), (T(2024, 1, 1, 14, 1), "h")],
           time.time() - 5)
    hours = jobs.hourly_counts(_source(spark, src), ["host"], "10 minutes")
    _, path = jobs.run_to_parquet(spark, hours, "open")
    held = jobs.open_hours(jobs.state_rows(spark, path + jobs.CHECKPOINT), ["host"])
    assert sorted((r.event_hour.hour, r.host, r.num_hits) for r in held.collect()) == [(13, "g", 1), (14, "h", 1)]
    every = jobs.complete(spark, hours, path, lambda s: jobs.open_hours(s, ["host"]))
    assert sorted(((r.event_hour.hour, str(r.host), r.num_hits) for r in every.collect())) == [
        (10, "h", 1), (11, "None", 2), (13, "g", 1), (14, "h", 1)]


def test_a_source_without_rows(spark, tmp_path):
    src = tmp_path / "none"
    src.mkdir()
    _write(src / "a.parquet", [], time.time() - 9)
    hours = jobs.hourly_counts(_source(spark, src), ["host"], "10 minutes")
    _, path = jobs.run_to_parquet(spark, hours, "none")
    assert jobs.complete(spark, hours, path, lambda s: jobs.open_hours(s, ["host"])).count() == 0


def test_keyed_sink_replays_and_restarts(spark, tmp_path):
    """A batch that is replayed changes nothing; a query that starts again from its checkpoint
    goes on with the same table, keys updated in place."""
    src = tmp_path / "src"
    src.mkdir()
    now = time.time()
    _write(src / "a.parquet", [(T(2024, 1, 1, 10, 5), "h"), (T(2024, 1, 1, 10, 6), "g")], now - 90)
    _write(src / "b.parquet", [(T(2024, 1, 1, 10, 9), "h"), (T(2024, 1, 2, 0, 1), None)], now - 80)
    keys, by = ["event_date", "event_hour", "host"], ["event_date"]

    def run(path=None):
        stream = jobs.hourly_counts(_source(spark, src), ["host"], "10 minutes").withColumn("event_date", F.to_date("event_hour"))
        _, at = jobs.run_keyed(spark, stream, "keyed", keys, by, path=path)
        return at, stream.schema

    def rows(path, schema):
        return sorted((r.event_hour.day, r.event_hour.hour, str(r.host), r.num_hits)
                      for r in spark.read.schema(schema).parquet(path).collect())
    path, schema = run()
    first = [(1, 10, "g", 1), (1, 10, "h", 2), (2, 0, "None", 1)]
    assert rows(path, schema) == first
    again = spark.createDataFrame([(T(2024, 1, 1, 10), "h", 99, dt.date(2024, 1, 1))],
                                  "event_hour timestamp_ntz, host string, num_hits long, event_date date")
    jobs.upsert_batch(path, keys, by)(again, 0)                    # a number that has been applied
    assert rows(path, schema) == first
    _write(src / "c.parquet", [(T(2024, 1, 2, 0, 9), None), (T(2024, 1, 2, 5, 0), "h")], now - 70)
    run(path)
    assert rows(path, schema) == [(1, 10, "g", 1), (1, 10, "h", 2), (2, 0, "None", 2), (2, 5, "h", 1)]
    run(path)                                                      # nothing new
    assert len(rows(path, schema)) == 4
