"""History as base and changes, and daily logs folded when they are read."""
from __future__ import annotations

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from snapfold.operators import cumulative as cu
from snapfold.operators import datelists as dl
from snapfold.operators import growth as gr
from snapfold.sources.sinks import upsert_frames

D = dt.date
DAY = "user_id int, date date, hits long"


def steps(spark, days, first, step, empty):
    """The step operator day after day: every snapshot."""
    state, out = empty, []
    for k, users in enumerate(days):
        d = first + dt.timedelta(days=k)
        state = spark.createDataFrame(step(state, spark.createDataFrame([(u, d) for u in users], "user_id int, d date")).collect(),
                                      empty.schema)
        out += state.collect()
    return sorted(out, key=str)


def test_folds_equal_the_steps(spark):
    rnd = random.Random(2)
    first = D(2024, 1, 30)
    days = [[u for u in range(6) if rnd.random() < 0.35] for _ in range(11)]
    days[3] = []                                            # a day without anyone
    daily = spark.createDataFrame([(u, first + dt.timedelta(days=k)) for k, us in enumerate(days) for u in us],
                                  "user_id int, date date")
    last = first + dt.timedelta(days=10)
    empty = spark.createDataFrame([], "user_id int, dates_active array<date>, date date")
    want = steps(spark, days, first, lambda s, t: dl.cumulate_dates(s, t.withColumnRenamed("d", "date_active")), empty)
    assert sorted(dl.fold_dates(daily, first, last).collect(), key=str) == want
    empty = spark.createDataFrame([], "user_id string, first_active_date date, last_active_date date, daily_active_state string, "
                                      "weekly_active_state string, dates_active array<date>, date date")
    for churn_first in (False, True):
        want = steps(spark, days, first, lambda s, t: gr.growth_step(s, t.withColumnRenamed("d", "today_date"), churn_first), empty)
        assert sorted(gr.fold_growth(daily, first, last, churn_first).collect(), key=str) == want


def test_catch_up_equals_one_period_a_job(spark):
    """Several periods in a job, whatever their number: the rows of the step by step fold,
    with entities that come late, sit out whole jobs and return, and a job without rows."""
    rnd = random.Random(5)
    first, last = D(2024, 1, 30), D(2024, 2, 7)
    rows = [(u, first + dt.timedelta(days=k)) for k in range(9) for u in range(8) if not 3 <= k < 6 and rnd.random() < 0.3]
    daily = spark.createDataFrame(rows, "user_id int, date date")
    stats = [(f"p{p}", 70, "c", "US", "2000", "1", "2", 10, float(rnd.randint(0, 30)), 1.0, 2.0, s)
             for s in range(1996, 2003) for p in range(6) if s != 1999 and rnd.random() < 0.5]
    seasons = spark.createDataFrame(stats, "player_name string, height int, college string, country string, draft_year string, "
                                           "draft_round string, draft_number string, gp int, pts double, reb double, ast double, season int")
    films = spark.createDataFrame([(f"a{a}", 2000 + y, f"f{k}", 10 * k, rnd.randint(50, 95) / 10, f"id{a}{y}{k}")
                                   for y in range(6) for a in range(5) for k in range(2) if rnd.random() < 0.4],
                                  "actor string, year int, film string, votes int, rating double, filmid string")
    folds = [lambda n: dl.fold_dates(daily, first, last, at_once=n),
             lambda n: gr.fold_growth(daily, first, last, at_once=n), lambda n: gr.fold_growth(daily, first, last, True, at_once=n),
             lambda n: cu.fold_players(seasons, 1996, 2002, at_once=n), lambda n: cu.fold_players(seasons, 1996, 2002, True, at_once=n),
             lambda n: cu.fold_actors(films, 2000, 2005, at_once=n), lambda n: cu.fold_actors(films, 2000, 2005, True, at_once=n)]
    for fold in folds:
        want = fold(1)
        for n in (3, 40):
            got = fold(n)
            assert got.dtypes == want.dtypes
            assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_catch_up_writes_what_the_days_write(spark):
    first = D(2024, 1, 1)
    rows = [(u, first) for u in range(50)] + [(k, first + dt.timedelta(days=k)) for k in range(1, 6)]
    daily = spark.createDataFrame(rows, "user_id int, date date")
    files = dl.fold_dates(daily, first, first + dt.timedelta(days=5), at_once=4).inputFiles()
    per = spark.read.parquet(*files).groupBy(cu.PERIOD).count().collect()
    assert {r[0]: r[1] for r in per} == {1: 50, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1}


def test_a_day_writes_the_users_that_it_saw(spark):
    """200 users on the first day, one each day after: what a day writes does not grow with
    those who are absent."""
    first = D(2024, 1, 1)
    rows = [(u, first) for u in range(200)] + [(k, first + dt.timedelta(days=k)) for k in range(1, 6)]
    daily = spark.createDataFrame(rows, "user_id int, date date")
    snaps = dl.fold_dates(daily, first, first + dt.timedelta(days=5))
    per: dict[int, int] = {}
    for f in snaps.inputFiles():
        n = int(f.split("/changes/")[1].split("/")[0])
        per[n] = per.get(n, 0) + spark.read.parquet(f).count()
    assert per == {1: 200, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1}
    assert snaps.count() == 1200 and snaps.where("size(dates_active) = 2").count() == 5 + 4 + 3 + 2 + 1


def test_bases_bound_what_a_step_reads(spark):
    """With a base after every period or after none the snapshots are the same."""
    seasons = spark.createDataFrame([("a", 1), ("b", 1), ("a", 3), ("c", 4), ("b", 5), ("a", 5)], "k string, season int")
    empty = spark.createDataFrame([], "k string, seen array<int>, at int")
    row = [F.coalesce("t_k", "y_k").alias("k"),
           F.concat(F.coalesce("y_seen", F.array().cast("array<int>")), F.array("t_season")).alias("seen"),
           F.col("t_season").alias("at")]
    got = [sorted(cu.fold_changes(empty, range(1, 6), "k", "season", lambda p: seasons.where(F.col("season") == p), row,
                                  lambda c, to: {"at": to}, base_every=n).collect()) for n in (1, 2, 99)]
    assert got[0] == got[1] == got[2]
    assert [(r.k, r.seen) for r in got[0] if r["at"] == 5] == [("a", [1, 3, 5]), ("b", [1, 5]), ("c", [4])]
    assert len(got[0]) == 5 + 5 + 2


def test_metric_log_equals_the_runs(spark, tmp_path):
    """Runs in any order, repeated and skipped: the folded log has what appends run after run give."""
    rnd = random.Random(4)
    days = [D(2023, 1, 2), D(2023, 1, 3), D(2023, 1, 3), D(2023, 1, 7), D(2023, 2, 1), D(2023, 1, 5), D(2023, 2, 4)]
    loads = [(d, [(u, d, rnd.randint(1, 9)) for u in range(5) if rnd.random() < 0.6]) for d in days]
    loads[3] = (days[3], [])
    path = str(tmp_path / "log")
    for run, (d, rows) in enumerate(loads, 1):
        dl.load_run(spark.createDataFrame(rows, DAY), d, run).write.mode("append").partitionBy("run").parquet(path)
    assert len(os.listdir(path)) >= len(days)
    log = spark.read.schema(DAY + ", run int").parquet(path)
    keys = ["user_id", "month_start", "metric_name"]
    for positional in (False, True):
        state = None
        for d, rows in loads:
            new = dl.append_metric(state, spark.createDataFrame(rows, DAY), d, positional=positional)
            state = new if state is None else upsert_frames(state, new, keys)
            state = spark.createDataFrame(state.collect(), new.schema)
        assert sorted(dl.fold_metric_log(log, positional=positional).collect()) == sorted(state.collect())


def test_reduced_log_equals_the_appends(spark):
    rows = [("a", D(2023, 1, 1), 5, 2), ("b", D(2023, 1, 1), 1, 1), ("a", D(2023, 1, 2), 7, 3), ("c", D(2023, 2, 2), 2, 2)]
    log = spark.createDataFrame(rows, "host string, date date, hits long, unique_visitors long")
    got = sorted((r.host, r.month.month, r.hit_array, r.unique_visitors_array) for r in dl.fold_reduced(log).collect())
    assert got == [("a", 1, [5, 7], [2, 3]), ("b", 1, [1], [1]), ("c", 2, [2], [2])]


def test_distinct_visitors_of_spans(spark):
    rnd = random.Random(9)
    users = [-70000, -5, -1, 0, 1, 32767, 32768, 32769, 5_000_000_000]
    rows = [(rnd.choice(["a", "b", None]), dt.datetime(2024, 1, rnd.randint(1, 20), 5), rnd.choice([*users, None])) for _ in range(400)]
    ev = spark.createDataFrame(rows, "host string, event_time timestamp_ntz, user_id long")
    got = dl.distinct_of_spans(dl.visitor_bitmaps(ev), {"day": F.col("date"), "week": F.trunc("date", "week")})
    want: dict = {}
    for h, t, u in rows:
        if h is not None and u is not None:
            for span, start in (("day", t.date()), ("week", t.date() - dt.timedelta(days=t.weekday()))):
                want.setdefault((h, span, start), set()).add(u)
    assert {(r.host, r.span, r.span_start): r.unique_visitors for r in got.collect()} == {k: len(v) for k, v in want.items()}
