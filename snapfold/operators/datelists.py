"""Date lists, 32-bit activity masks and monthly metric arrays.

Lists are kept per entity and per calendar day, so their length is bounded by
the calendar, never by the number of events of a busy entity. Event tables
are reduced to (entity, day) rows with a partial aggregation before anything
is collected.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.functions.pgcompat import DAY_MASK, MASK_32, WEEK_MASK, bit32, bit32_text, has_any_bit
from snapfold.operators.cumulative import Row, fold_changes, prefixed


def day_range(c: str, day: dt.date) -> Column:
    """``DATE(c) = day`` as a half-open range on the raw timestamp, which
    Parquet row-group statistics can skip on."""
    lo = F.lit(day.isoformat()).cast("timestamp_ntz")
    hi = F.lit((day + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    return (F.col(c) >= lo) & (F.col(c) < hi)


def before_day(c: str, day: dt.date) -> Column:
    """``DATE(c) < day`` on the raw timestamp."""
    return F.col(c) < F.lit(day.isoformat()).cast("timestamp_ntz")


def event_range(events: DataFrame, c: str = "event_time") -> DataFrame:
    return events.agg(F.max(c).alias("max_event_time"), F.min(c).alias("min_event_time"))


def daily_activity(events: DataFrame, key: str = "user_id", ts: str = "event_time") -> DataFrame:
    """(key, date, hits) for non-null keys: the narrow table every date-list
    and metric-array job starts from (partial aggregation before the shuffle)."""
    return (events.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
                  .groupBy(key, F.to_date(ts).alias("date"))
                  .agg(F.count(F.lit(1)).alias("hits")))


# --------------------------------------------------------------------------- users_cumulated
def cumulate_dates(prev: DataFrame, today: DataFrame, key: str = "user_id") -> DataFrame:
    """One day of ``users_cumulated``: today's date is prepended to the list;
    absent users are carried forward with date = yesterday + 1.
    ``today`` = (key, date_active) rows of one day."""
    t = today.select(F.col(key).alias("t_" + key), F.col("date_active").alias("t_date_active"))
    y = prev.select(*[F.col(c).alias("y_" + c) for c in (key, "dates_active", "date")])
    return t.join(y, F.col("t_" + key) == F.col("y_" + key), "full_outer") \
        .select(*_dates_row(key)(prefixed("t_"), prefixed("y_")))


def _dates_row(key: str) -> Row:
    """The new state from today's row and the snapshot of the day before."""
    def row(t, y):
        today_arr = F.array(t("date_active"))
        return [
            F.coalesce(t(key), y(key)).alias(key),
            F.when(y("dates_active").isNull(), today_arr)
             .when(t("date_active").isNull(), y("dates_active"))
             .otherwise(F.concat(today_arr, y("dates_active"))).alias("dates_active"),
            F.coalesce(t("date_active"), F.date_add(y("date"), 1)).alias("date")]
    return row


def fold_dates(daily: DataFrame, first: dt.date, last: dt.date, key: str = "user_id", at_once: int = 1) -> DataFrame:
    """All snapshots of ``users_cumulated`` first..last, day by day; a day writes the users
    that it saw. ``daily`` = (key, date) rows, staged by date."""
    empty = daily.limit(0).select(key, F.array(F.col("date")).alias("dates_active"), "date")
    today = lambda d, to=None: daily.where(F.col("date").between(F.lit(d), F.lit(to or d))) \
        .select(key, F.col("date").alias("date_active"))
    return fold_changes(empty, each_day(first, last), key, "date_active", today,
                        _dates_row(key), lambda c, at: {"date": at}, at_once=at_once)


def each_day(lo: dt.date, hi: dt.date) -> list[dt.date]:
    return [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]


def backfill_dates(daily: DataFrame, end: Column, key: str = "user_id") -> DataFrame:
    """Every (key, date) snapshot of ``users_cumulated`` up to ``end`` in one
    pass: the newest-first list of active days up to the snapshot date."""
    per = daily.groupBy(key).agg(F.min("date").alias("first"),
                                 F.sort_array(F.collect_set("date"), asc=False).alias("days"))
    grid = per.select(key, "days", F.explode(F.sequence("first", end)).alias("date"))
    return grid.select(key, F.filter("days", lambda d: d <= F.col("date")).alias("dates_active"), "date")


def date_bitmask(users: DataFrame, anchor: Column, start: Column, fixed: bool = False,
                 key: str = "user_id") -> DataFrame:
    """Date list -> 32-bit activity mask relative to ``anchor`` over the days
    ``start``..``anchor``; monthly / weekly / daily active flags.

    Per row with ``aggregate`` over the list - no users x days cross join and no
    shuffle. As written the bit of a day of age a is 2^(32-a): age 0 falls
    outside 32 bits, so "daily" tests age 1 and "weekly" ages 1-7. ``fixed``
    uses 2^(31-a)."""
    top = 31 if fixed else 32
    # bounds become columns first: subqueries may not sit inside lambdas
    u = users.select(key, "dates_active", anchor.alias("_anchor"), start.alias("_start"))
    a, s = F.col("_anchor"), F.col("_start")
    # a day over ``top`` days old has no bit, however early ``start`` is
    days = F.filter(F.array_distinct("dates_active"),
                    lambda d: (d >= s) & (d <= a) & (F.datediff(a, d) <= F.lit(top)))
    one = F.lit(1).cast("bigint")
    total = F.aggregate(days, F.lit(0).cast("bigint"),
                        lambda acc, d: acc + F.call_function("shiftleft", one, F.lit(top) - F.datediff(a, d)))
    return u.select(key, total.alias("bits_sum")).select(
        key, "bits_sum",
        bit32("bits_sum").alias("bits32"),
        bit32_text("bits_sum").alias("bits32_text"),
        has_any_bit("bits_sum", MASK_32).alias("dim_monthly_active"),
        has_any_bit("bits_sum", WEEK_MASK).alias("dim_weekly_active"),
        has_any_bit("bits_sum", DAY_MASK).alias("dim_daily_active"))


# --------------------------------------------------------------------------- device date lists
def device_datelist(events: DataFrame, devices: DataFrame, na: str = "N/A") -> DataFrame:
    """user -> map(browser_type -> sorted distinct active days).

    A NULL browser becomes ``na`` (a map key cannot be NULL). The list holds
    days, as the table comment intends; distinct (user, browser, day) rows are
    formed by a partial aggregation before they are collected."""
    d = devices.select("device_id", F.coalesce("browser_type", F.lit(na)).alias("browser_type"))
    e = events.where(F.col("event_time").isNotNull() & F.col("user_id").isNotNull())
    days = (e.join(d, "device_id").select("user_id", "browser_type", F.to_date("event_time").alias("d"))
             .distinct())
    per_browser = days.groupBy("user_id", "browser_type").agg(F.sort_array(F.collect_list("d")).alias("dates"))
    return per_browser.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("browser_type", "dates"))).alias("device_activity_datelist"))


def datelist_to_int(df: DataFrame, col: str = "device_activity_datelist") -> DataFrame:
    """map(browser -> dates) -> map(browser -> YYYYMMDD ints) in list order.
    The lists are already sorted, so this is a per-row transform."""
    as_int = F.transform_values(col, lambda k, v: F.transform(
        v, lambda x: F.date_format(x, "yyyyMMdd").cast("int")))
    return df.select("user_id", as_int.alias("datelist_int"))


def explode_map(df: DataFrame, col: str, key_name: str, value_name: str, keys=("user_id",)) -> DataFrame:
    return df.select(*keys, F.explode(col).alias(key_name, value_name))


# --------------------------------------------------------------------------- hosts_cumulated
def merge_datelist(stored: DataFrame | None, events: DataFrame, key: str = "host",
                   ts: str = "event_time", out: str = "host_datelist") -> DataFrame:
    """Merge the days of new events into the stored per-host date list:
    union, distinct, sorted; hosts only in the store keep their list (the
    script would emit them with a NULL host and fail its primary key)."""
    new = (events.where(F.col(ts).isNotNull() & F.col(key).isNotNull())
                 .select(key, F.to_date(ts).alias("d")).distinct()
                 .groupBy(key).agg(F.collect_list("d").alias("new_list")))
    if stored is None:
        return new.select(key, F.array_sort(F.array_distinct("new_list")).alias(out))
    s = stored.select(F.col(key).alias("s_key"), F.col(out).alias("s_list"))
    j = new.join(s, new[key] == s.s_key, "full_outer")
    merged = F.array_sort(F.array_distinct(F.concat(F.coalesce("s_list", F.array().cast("array<date>")),
                                                   F.coalesce("new_list", F.array().cast("array<date>")))))
    return j.select(F.coalesce(F.col(key), F.col("s_key")).alias(key), merged.alias(out))


# --------------------------------------------------------------------------- host_activity_reduced
def reduce_monthly(events: DataFrame, zero_fill: bool = False, key: str = "host",
                   ts: str = "event_time", visitor: str = "user_id") -> DataFrame:
    """Per (month, host): array of daily hits and of daily distinct visitors.

    Two-level aggregation: (month, host, day) with map-side partial counts and
    a distinct on (..., visitor), then at most 31 rows per (month, host). As
    written days without hits are skipped (position != day of month);
    ``zero_fill`` puts day d at position d."""
    e = events.where(F.col(ts).isNotNull() & F.col(key).isNotNull() & F.col(visitor).isNotNull())
    d = F.to_date(ts)
    daily = e.groupBy(F.trunc(d, "month").alias("month"), key, F.dayofmonth(d).alias("day")).agg(
        F.count(F.lit(1)).alias("hits"), F.countDistinct(visitor).alias("unique_visitors"))
    per = daily.groupBy("month", key).agg(
        F.sort_array(F.collect_list(F.struct("day", "hits", "unique_visitors"))).alias("days"))
    if not zero_fill:
        return per.select("month", key,
                          F.transform("days", lambda x: x["hits"]).alias("hit_array"),
                          F.transform("days", lambda x: x["unique_visitors"]).alias("unique_visitors_array"))
    by_day = F.map_from_entries(F.transform("days", lambda x: F.struct(x["day"], x)))
    month_days = F.sequence(F.lit(1), F.dayofmonth(F.last_day("month")))

    def filled(field: str) -> Column:
        return F.transform(month_days, lambda i: F.coalesce(F.element_at(by_day, i)[field], F.lit(0).cast("bigint")))
    return per.select("month", key, filled("hits").alias("hit_array"),
                      filled("unique_visitors").alias("unique_visitors_array"))


def daily_hosts(events: DataFrame, key: str = "host", ts: str = "event_time",
                visitor: str = "user_id") -> DataFrame:
    """(key, date, hits, unique_visitors) per host and day."""
    e = events.where(F.col(ts).isNotNull() & F.col(key).isNotNull() & F.col(visitor).isNotNull())
    return e.groupBy(key, F.to_date(ts).alias("date")).agg(
        F.count(F.lit(1)).alias("hits"), F.countDistinct(visitor).alias("unique_visitors"))


def append_reduced(stored: DataFrame | None, today: DataFrame, day: dt.date, key: str = "host") -> DataFrame:
    """One day of the monthly arrays: the day's hosts with their counts appended
    to what is stored for the month, the rows to upsert on (month, host). Hosts
    without hits that day are left as they are, as the script does."""
    month = F.lit(day.replace(day=1))
    t = today.select(key, "hits", "unique_visitors")
    new = {"hit_array": F.array("hits"), "unique_visitors_array": F.array("unique_visitors")}
    if stored is None:
        return t.select(month.alias("month"), key, *[v.alias(c) for c, v in new.items()])
    old = stored.where(F.col("month") == month).select(F.col(key).alias("o_key"), *new)
    return t.join(old, F.col(key) == F.col("o_key"), "left").select(
        month.alias("month"), key, *[F.concat(F.coalesce(F.col(c), F.array().cast("array<bigint>")), v).alias(c)
                                     for c, v in new.items()])


def fold_reduced(log: DataFrame, key: str = "host", run: str = "date") -> DataFrame:
    """The monthly arrays from a log of daily loads (key, date, hits, unique_visitors), a
    partition a day: what ``append_reduced`` gives run after run, in the order of ``run``.
    A day's load writes that day; the month is folded when it is read."""
    per = log.groupBy(F.trunc("date", "month").alias("month"), key).agg(
        F.sort_array(F.collect_list(F.struct(run, "hits", "unique_visitors"))).alias("days"))
    return per.select("month", key, F.transform("days", lambda x: x["hits"]).alias("hit_array"),
                      F.transform("days", lambda x: x["unique_visitors"]).alias("unique_visitors_array"))


# --------------------------------------------------------------------------- distinct visitors of any span
def visitor_bitmaps(events: DataFrame, key: str = "host", ts: str = "event_time",
                    visitor: str = "user_id") -> DataFrame:
    """(key, date, bucket, visitors): mergeable exact state of distinct integer visitors, a
    bitmap of 32768 ids for each (key, day) and bucket of ids that has any. Built in partial
    aggregates; a state is as large as the buckets that the day's visitors fall into."""
    e = events.where(F.col(ts).isNotNull() & F.col(key).isNotNull() & F.col(visitor).isNotNull())
    return e.groupBy(key, F.to_date(ts).alias("date"), F.bitmap_bucket_number(visitor).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(visitor)).alias("visitors"))


def distinct_of_spans(state: DataFrame, spans: dict[str, Column], key: str = "host") -> DataFrame:
    """(key, span, span_start, unique_visitors) for spans of days, each a name and the
    start of a day's span: the days' bitmaps united, so a visitor of several days counts
    once. No visitor is read again."""
    starts = F.array(*[F.struct(F.lit(name).alias("span"), start.alias("span_start")) for name, start in spans.items()])
    united = (state.select(key, "bucket", "visitors", F.explode(starts).alias("s"))
              .groupBy(key, "s.span", "s.span_start", "bucket").agg(F.bitmap_or_agg("visitors").alias("visitors")))
    return united.groupBy(key, "span", "span_start").agg(
        F.sum(F.bitmap_count("visitors")).cast("bigint").alias("unique_visitors"))


# --------------------------------------------------------------------------- array_metrics
METRIC = "site_hits"


def append_metric(state: DataFrame | None, today: DataFrame, day: dt.date, metric: str = METRIC,
                  positional: bool = False) -> DataFrame:
    """One day of ``array_metrics``: append today's count (0 if absent) to each
    user's array of the month; a user first seen today gets zeros for the
    earlier days of the month. ``today`` = (user_id, date, hits) of ``day``.
    Returns all rows of the (month, metric), those of absent users included, so
    that they replace its partition.

    As written the count is appended, so re-running a day appends twice and a
    skipped day shifts later positions, and the month's rows are read for
    every metric. ``positional`` writes the count at position day - month
    start (zero padding, replacing a value already there) and reads only this
    metric: re-runs are idempotent."""
    month = day.replace(day=1)
    da = today.select(F.col("user_id").alias("d_user"), F.col("date").alias("d_date"),
                      F.col("hits").alias("d_hits"))
    if state is None:
        ya = da.limit(0).select(F.col("d_user").alias("y_user"), F.lit(None).cast("date").alias("y_month"),
                                F.lit(None).cast("string").alias("y_metric"),
                                F.array().cast("array<double>").alias("y_array"))
    else:
        ya = state.where(F.col("month_start") == F.lit(month))
        if positional:
            ya = ya.where(F.col("metric_name") == metric)
        ya = ya.select(F.col("user_id").alias("y_user"), F.col("month_start").alias("y_month"),
                       F.col("metric_name").alias("y_metric"), F.col("metric_array").alias("y_array"))
    j = da.join(ya, F.col("d_user") == F.col("y_user"), "full_outer")
    hits = F.coalesce("d_hits", F.lit(0)).cast("double")
    count = F.array(hits)
    lead = F.coalesce(F.datediff("d_date", F.trunc("d_date", "month")), F.lit(0))
    if positional:
        old = F.coalesce("y_array", F.array().cast("array<double>"))
        slot = F.lit((day - month).days)
        last = F.greatest(slot, F.size(old) - 1)
        arr = F.transform(F.sequence(F.lit(0), last), lambda i: F.when(i == slot, hits).otherwise(
            F.coalesce(F.try_element_at(old, i + 1), F.lit(0.0))))
    else:
        arr = (F.when(F.col("y_metric").isNotNull(), F.concat("y_array", count))
                .otherwise(F.concat(F.array_repeat(F.lit(0.0), lead), count)))
    return j.select(
        F.coalesce("d_user", "y_user").alias("user_id"),
        F.coalesce("y_month", F.trunc("d_date", "month")).alias("month_start"),
        F.lit(metric).alias("metric_name"),
        arr.alias("metric_array"))


def load_run(today: DataFrame, day: dt.date, run: int) -> DataFrame:
    """What one run of the daily load writes to the log, its own partition: a row without a
    user that says which day it loaded, and the day's users. ``today`` as in ``append_metric``."""
    rows = today.select("user_id", "date", "hits")
    nulls = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("user_id", "hits")]
    head = today.sparkSession.range(1).select(nulls[0], F.lit(day).alias("date"), nulls[1])
    return head.unionByName(rows).withColumn("run", F.lit(run))


def backfill_log(daily: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """The log of one run for each day first..last, all in one pass."""
    spark = daily.sparkSession
    number = lambda df: df.withColumn("run", F.datediff("date", F.lit(first)) + 1)
    rows = daily.select("user_id", "date", "hits")
    heads = spark.range(1).select(F.lit(None).cast(rows.schema["user_id"].dataType).alias("user_id"),
                                  F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"),
                                  F.lit(None).cast(rows.schema["hits"].dataType).alias("hits"))
    return number(heads.unionByName(rows))


def fold_metric_log(log: DataFrame, metric: str = METRIC, positional: bool = False) -> DataFrame:
    """``array_metrics`` from a log of daily runs, a partition each (``load_run``): the arrays
    that ``append_metric`` gives run after run. A run writes its day and reads nothing; the
    month is folded when it is read, in one aggregation by user and month.

    A user's array starts with the first run that saw them in the month. As written, zeros
    for the days before it and then a count for each run from it on, so a repeated or
    skipped day shifts what follows. ``positional``: each day's place holds the count of the
    last run of that day. The runs of a month, at most a few a day, are broadcast."""
    month = F.trunc("date", "month")
    runs = log.where(F.col("user_id").isNull()).groupBy(month.alias("month_start")).agg(
        F.sort_array(F.collect_list(F.struct("run", F.datediff("date", F.trunc("date", "month")).alias("slot")))).alias("runs"))
    per = log.where(F.col("user_id").isNotNull()).groupBy("user_id", month.alias("month_start")).agg(
        F.min(F.struct("run", "date")).alias("first"),
        F.map_from_entries(F.collect_list(F.struct("run", "hits"))).alias("by_run"))
    own = per.join(F.broadcast(runs), "month_start").withColumn(
        "runs", F.filter("runs", lambda r: r["run"] >= F.col("first.run")))
    count = lambda run: F.coalesce(F.try_element_at("by_run", run), F.lit(0)).cast("double")
    if positional:
        slots = F.transform("runs", lambda r: r["slot"])
        of_slot = lambda i: F.array_max(F.transform(F.filter("runs", lambda r: r["slot"] == i), lambda r: r["run"]))
        arr = F.transform(F.sequence(F.lit(0), F.array_max(slots)),
                          lambda i: F.when(F.array_contains(slots, i), count(of_slot(i))).otherwise(F.lit(0.0)))
    else:
        lead = F.datediff("first.date", "month_start")
        arr = F.concat(F.array_repeat(F.lit(0.0), lead), F.transform("runs", lambda r: count(r["run"])))
    return own.select("user_id", "month_start", F.lit(metric).alias("metric_name"), arr.alias("metric_array"))


def backfill_metric_arrays(daily: DataFrame, end: Column, metric: str = METRIC) -> DataFrame:
    """The folded ``array_metrics`` of a month in one pass: per user the
    zero-filled daily counts from the month start to ``end``."""
    per = daily.groupBy("user_id", F.trunc("date", "month").alias("month_start")).agg(
        F.map_from_entries(F.collect_list(F.struct("date", "hits"))).alias("by_day"))
    per = per.withColumn("_days", F.sequence(F.col("month_start"), end))
    days = F.col("_days")
    return per.select("user_id", "month_start", F.lit(metric).alias("metric_name"),
                      F.transform(days, lambda d: F.coalesce(F.element_at("by_day", d), F.lit(0))
                                  .cast("double")).alias("metric_array"))


def array_length_audit(df: DataFrame, col: str = "metric_array") -> DataFrame:
    return df.groupBy(F.size(col).alias("array_length")).agg(F.count(F.lit(1)).alias("num_rows"))


def metric_daily(df: DataFrame, positions: int | None = None) -> DataFrame:
    """Sum the arrays by position per (metric, month) and turn them back into
    (metric, date, value) rows: every position (posexplode + one partial/final
    aggregation). ``positions`` sums only the first ones, as the script writes
    them out (a missing element sums to NULL)."""
    if positions is not None:
        summed = df.groupBy("metric_name", "month_start").agg(
            F.array(*[F.sum(F.try_element_at("metric_array", F.lit(i))) for i in range(1, positions + 1)])
             .alias("summed"))
        exploded = summed.select("metric_name", "month_start", F.posexplode("summed").alias("pos", "value"))
    else:
        exploded = (df.select("metric_name", "month_start", F.posexplode("metric_array").alias("pos", "v"))
                      .groupBy("metric_name", "month_start", "pos").agg(F.sum("v").alias("value")))
    return exploded.select("metric_name", F.date_add("month_start", F.col("pos")).alias("metric_date"),
                           F.col("value").cast("double").alias("value"))
