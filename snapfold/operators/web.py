"""Web-traffic reports over the stream sink tables (processed events, hourly
counts, sessions). The same aggregation functions build those tables from a
batch DataFrame here and from a stream in ``snapfold.streaming``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from snapfold.functions.joins import plain_keys, restored
from snapfold.functions.pgcompat import wall_clock, wall_instant
from snapfold.session import cut_lineage

# Session gap and watermark delay: the reference does not state them; ours.
SESSION_GAP = "30 minutes"
WATERMARK_DELAY = "10 minutes"


def event_ts(c: str = "event_time", df: DataFrame | None = None) -> Column:
    """Event time as TIMESTAMP: watermarks and session windows need it; the
    sources carry TIMESTAMP_NTZ, read as a UTC wall clock so windows do not
    depend on the session time zone (``pgcompat.wall_instant``). A column
    that already is a TIMESTAMP is used as is, so a watermark on it stays
    visible."""
    if df is not None and isinstance(df.schema[c].dataType, TimestampType):
        return F.col(c)
    return wall_instant(c)


def count_by_json(df: DataFrame, col: str, path: str, name: str, top: int | None = 10) -> DataFrame:
    """Rows per value of a JSON member, the ``top`` largest (ties by value)."""
    agg = df.groupBy(F.get_json_object(col, path).alias(name)).agg(F.count(F.lit(1)).alias("num_hits"))
    if top is None:
        return agg
    return agg.orderBy(F.col("num_hits").desc(), F.col(name).asc_nulls_first()).limit(top)


def hourly_counts(events: DataFrame, keys: list[str], ts: str = "event_time") -> DataFrame:
    """(event_hour, keys..., num_hits) from a batch or streaming DataFrame.

    ``window`` works for both; on a stream the caller adds the watermark."""
    w = F.window(event_ts(ts, events), "1 hour")
    return (events.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("num_hits"))
                  .select(wall_clock("w.start").alias("event_hour"), *keys, "num_hits"))


def sessions(events: DataFrame, keys: list[str], gap: str = SESSION_GAP, ts: str = "event_time") -> DataFrame:
    """One row per session of ``keys``, times as a TIMESTAMP(3) sink keeps them: a session ends when the next event is
    more than ``gap`` after the last one (sessions that touch merge);
    end = last event + gap."""
    sw = F.session_window(event_ts(ts, events), gap)
    return (events.where(F.col(ts).isNotNull())
                  .groupBy(sw.alias("s"), *keys).agg(F.count(F.lit(1)).alias("num_hits"))
                  .select(wall_clock("s.start").alias("session_start"),
                          wall_clock("s.end").alias("session_end"),
                          *keys, "num_hits")
                  .select(to_millis("session_start"), to_millis("session_end"), *keys, "num_hits"))


def _carry_before(per_bucket: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Per (keys, bucket): the max of ``value`` over all earlier buckets of the
    key - a window over one row per non-empty bucket."""
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(*keys, "_b", F.max(value).over(w).alias(out))


def sessions_bucketed(events: DataFrame, keys: list[str], gap_minutes: int = 30, ts: str = "event_time",
                      bucket_hours: int = 1) -> DataFrame:
    """The ``sessions`` result without putting a key's events in one task.

    Events are cut into time buckets of a key. (1) The previous event of each
    event comes from a window inside its bucket, or for the first event of a
    bucket from the latest event of earlier buckets (carried through a window
    over one row per non-empty bucket). An event more than the gap after its
    previous event starts a session. (2) The same two-level lookup gives each
    event the latest session start at or before it. (3) Sessions are an
    aggregation on (keys, session_start) - combined map-side, so one long
    session of a busy key is still spread over the map tasks."""
    gap = F.expr(f"INTERVAL {int(gap_minutes)} MINUTES")
    t = F.col(ts).cast("timestamp_ntz")
    hours = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")) * 24 + F.hour(t)
    e, plain = plain_keys(events.where(F.col(ts).isNotNull()).select(
        *keys, t.alias("_t"), F.floor(hours / F.lit(bucket_hours)).alias("_b")), keys)
    by = [*plain, "_b"]
    inside = Window.partitionBy(*by).orderBy("_t")
    upto = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    per_bucket = e.groupBy(*by).agg(F.max("_t").alias("_bmax"))
    prev = e.select("*", F.lag("_t").over(inside).alias("_prev_local")) \
        .join(_carry_before(per_bucket, plain, "_bmax", "_prev_carry"), by)
    prev_t = F.coalesce("_prev_local", "_prev_carry")
    flagged = prev.select(*by, "_t", (prev_t.isNull() | ((F.col("_t") - prev_t) > gap)).alias("_start"))
    start_t = F.when(F.col("_start"), F.col("_t"))
    local = flagged.select(*by, "_t", F.max(start_t).over(upto).alias("_s_local"))
    starts = flagged.groupBy(*by).agg(F.max(start_t).alias("_bstart"))
    labelled = local.join(_carry_before(starts, plain, "_bstart", "_s_carry"), by)
    per_session = labelled.groupBy(*plain, F.coalesce("_s_local", "_s_carry").alias("session_start")).agg(
        F.max("_t").alias("_last"), F.count(F.lit(1)).alias("num_hits"))
    return per_session.withColumn("session_end", F.col("_last") + gap).select(
        to_millis("session_start"), to_millis("session_end"), *restored(keys), "num_hits")


def to_millis(c: str, name: str | None = None) -> Column:
    """A TIMESTAMP_NTZ as a TIMESTAMP(3) sink keeps it."""
    return F.date_trunc("MILLISECOND", F.col(c).cast("timestamp")).cast("timestamp_ntz").alias(name or c)


def share_of_total(hourly: DataFrame, like: str, listed, key: str = "host") -> DataFrame:
    """Hours with hits per matching key and its share of all matching keys'
    hours, reported for the listed keys. The events are aggregated once, to one
    stored row per key; the total is a scalar over those rows."""
    hours = cut_lineage(hourly.where(F.col(key).like(like)).groupBy(key)
                        .agg(F.count("event_hour").alias("hours_seen")), "parquet")
    total = hours.select(F.sum("hours_seen")).scalar()
    return (hours.where(F.col(key).isin(list(listed)))
                 .select(key, "hours_seen", (F.col("hours_seen") / total).alias("share_of_hours")))


def avg_rows_per_key(hourly: DataFrame, like: str | None = None, key: str = "host") -> DataFrame:
    """AVG over the per-key row count, per key (one row per key, so the
    average equals the count - kept as written)."""
    h = hourly if like is None else hourly.where(F.col(key).like(like))
    per = h.groupBy(key).agg(F.count(F.lit(1)).alias("event_count"))
    return per.groupBy(key).agg(F.avg("event_count").alias("avg_events_per_session"))


def avg_per_session(sessions_df: DataFrame, like: str | None = None, listed=None, by: str | None = None,
                    weight: str = "num_hits", name: str = "average_events_per_session",
                    one_row: bool = False) -> DataFrame:
    """Average events per (session_start, ip, host), overall or per ``by``.

    The script counts sink rows per session; on one-row-per-event data that is
    the event count, which a per-session sink carries as ``weight``. ``one_row``
    says that the rows are sessions of (ip, host) already, as
    ``sessions_bucketed`` makes them: they are not grouped again."""
    s = sessions_df
    if like is not None:
        s = s.where(F.col("host").like(like))
    if listed is not None:
        s = s.where(F.col("host").isin(list(listed)))
    per = (s.withColumn("_n", F.col(weight)) if one_row
           else s.groupBy("session_start", "ip", "host").agg(F.sum(weight).alias("_n")))
    if by is None:
        return per.agg(F.avg("_n").alias(name))
    return per.groupBy(by).agg(F.avg("_n").alias(name))
