"""Hand-made edge rows: nulls, empty and one-sided inputs, ties, flips."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import Window
from pyspark.sql import functions as F

from snapfold.functions import pgcompat as pg
from snapfold.operators import cubes, cumulative as cu, datelists as dl, facts, growth as gr
from snapfold.operators import scd, sequences, web

D = dt.date


def seasons_df(spark, rows):
    cols = ["player_name", *cu.PLAYER_STATIC, "season", "gp", "pts", "reb", "ast"]
    return spark.createDataFrame(
        [(n, "h", "c", "x", "1", "1", "1", s, 1, float(p), 1.0, 1.0) for n, s, p in rows],
        "player_name string, height string, college string, country string, draft_year string, "
        "draft_round string, draft_number string, season int, gp int, pts double, reb double, ast double"
    ).select(*cols)


def test_player_step_yesterday_today_both(spark):
    seasons = seasons_df(spark, [("only_yesterday", 2000, 25), ("both", 2000, 12), ("both", 2001, 16),
                                 ("only_today", 2001, 5)])
    snaps = cu.fold_players(seasons, 2000, 2001, fixed=True)
    last = {r["player_name"]: r for r in snaps.where("current_season = 2001").collect()}
    assert set(last) == {"only_yesterday", "both", "only_today"}
    assert last["only_yesterday"]["years_since_last_season"] == 1
    assert last["only_yesterday"]["scoring_class"] == "star"      # carried forward
    assert last["only_yesterday"]["is_active"] is False
    assert [s["season"] for s in last["both"]["season_stats"]] == [2000, 2001]
    assert last["both"]["scoring_class"] == "good"
    assert last["only_today"]["scoring_class"] == "bad"
    # as written the 12th column stays NULL
    asw = cu.fold_players(seasons, 2000, 2001).where("current_season = 2001").collect()
    assert all(r["is_active"] is None for r in asw)


def test_backfill_equals_fold(spark):
    seasons = seasons_df(spark, [("a", 1996, 21), ("a", 1998, 11), ("b", 1997, 16), ("b", 1998, 3)])
    cols = ["player_name", "current_season", "scoring_class", "years_since_last_season", "is_active"]
    fold = cu.fold_players(seasons, 1996, 1998, fixed=True).select(*cols, "season_stats")
    back = cu.backfill_players(seasons).select(*cols, "season_stats")
    assert sorted(fold.collect()) == sorted(back.collect())


def test_scd_flip_a_b_a(spark):
    rows = [("p", s, c, True) for s, c in [(1, "good"), (2, "bad"), (3, "good")]]
    df = spark.createDataFrame(rows, "player_name string, current_season int, scoring_class string, is_active boolean")
    as_written = scd.scd2_backfill(df, "player_name", "current_season", ["scoring_class", "is_active"], 3)
    fixed = scd.scd2_backfill(df, "player_name", "current_season", ["scoring_class", "is_active"], 3, fixed=True)
    aw = sorted((r["scoring_class"], r["start_season"], r["end_season"]) for r in as_written.collect())
    fx = sorted((r["scoring_class"], r["start_season"], r["end_season"]) for r in fixed.collect())
    assert aw == [("bad", 2, 2), ("good", 1, 3)]  # streaks merge and overlap
    assert fx == [("bad", 2, 2), ("good", 1, 1), ("good", 3, 3)]


def test_scd_fixed_has_no_overlaps_and_covers(spark):
    rows = [("p", s, c, a) for s, c, a in [(1, "good", True), (2, "good", True), (3, "bad", False),
                                           (4, "good", True), (5, "good", None)]]
    df = spark.createDataFrame(rows, "player_name string, current_season int, scoring_class string, is_active boolean")
    out = scd.scd2_backfill(df, "player_name", "current_season", ["scoring_class", "is_active"], 5, fixed=True)
    spans = sorted((r["start_season"], r["end_season"]) for r in out.collect())
    covered = [s for a, b in spans for s in range(a, b + 1)]
    assert covered == [1, 2, 3, 4, 5]


def test_state_change_first_inactive_is_stayed_retired(spark):
    df = spark.createDataFrame([("p", 1, False), ("p", 3, True), ("p", 5, False), ("q", 1, True), ("q", 2, True)],
                               "player_name string, start_season int, is_active boolean")
    got = {(r["player_name"], r["start_season"]): r["player_status"] for r in scd.state_change(df).collect()}
    assert got == {("p", 1): "Stayed Retired", ("p", 3): "Returned from Retirement", ("p", 5): "Retired",
                   ("q", 1): "New", ("q", 2): "Continued Playing"}


def test_bitmask_ages(spark):
    anchor = D(2023, 1, 31)
    users = spark.createDataFrame([(1, [anchor, D(2023, 1, 30), D(2023, 1, 1)]), (2, [anchor]), (3, [])],
                                  "user_id int, dates_active array<date>")
    a, s = F.lit(anchor), F.lit(D(2023, 1, 1))
    aw = {r["user_id"]: r for r in dl.date_bitmask(users, a, s).collect()}
    fx = {r["user_id"]: r for r in dl.date_bitmask(users, a, s, fixed=True).collect()}
    assert aw[1]["bits32"] == 2147483652 and fx[1]["bits32"] == 3221225474
    assert aw[2]["bits32"] == 0 and not aw[2]["dim_daily_active"]        # age 0 lost as written
    assert fx[2]["bits32"] == 2 ** 31 and fx[2]["dim_daily_active"]
    assert fx[1]["bits32_text"].startswith("11") and len(fx[1]["bits32_text"]) == 32
    assert aw[3]["bits_sum"] == 0 and not aw[3]["dim_monthly_active"]


def test_users_cumulated_prepends_and_carries(spark):
    prev = spark.createDataFrame([(1, [D(2023, 1, 1)], D(2023, 1, 1))], "user_id int, dates_active array<date>, date date")
    today = spark.createDataFrame([(2, D(2023, 1, 2))], "user_id int, date_active date")
    got = {r["user_id"]: r for r in dl.cumulate_dates(prev, today).collect()}
    assert got[1]["date"] == D(2023, 1, 2) and got[1]["dates_active"] == [D(2023, 1, 1)]
    assert got[2]["dates_active"] == [D(2023, 1, 2)]
    today1 = spark.createDataFrame([(1, D(2023, 1, 2))], "user_id int, date_active date")
    got1 = dl.cumulate_dates(prev, today1).collect()[0]
    assert got1["dates_active"] == [D(2023, 1, 2), D(2023, 1, 1)]


def test_metric_array_late_joiner_zero_filled(spark):
    today = spark.createDataFrame([(7, D(2023, 1, 4), 3)], "user_id int, date date, hits bigint")
    r = dl.append_metric(None, today, D(2023, 1, 4)).collect()[0]
    assert r["metric_array"] == [0.0, 0.0, 0.0, 3.0] and r["month_start"] == D(2023, 1, 1)


def test_growth_states(spark):
    rows = [(1, D(2023, 1, d)) for d in (1, 2, 5)]
    daily = spark.createDataFrame(rows, "user_id int, date date")
    got = {r["date"].day: (r["daily_active_state"], r["weekly_active_state"])
           for r in gr.growth_backfill(daily, F.lit(D(2023, 1, 14))).collect()}
    assert got[1] == ("New", "New") and got[2] == ("Retained", "Retained")
    assert got[3] == ("Churned", "Retained") and got[4] == ("Stale", "Retained")
    assert got[5][0] == "Resurrected" and got[6][0] == "Churned"
    assert got[14] == ("Stale", "Stale")


def test_fact_minutes_without_colon_and_null_comment(spark):
    counters = ", ".join(f"`{c}` int" for c in ("fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb",
                                                "reb", "ast", "stl", "blk", "TO", "pf"))
    details = spark.createDataFrame(
        [(1, 1, 1, "a", None, None, "12", *([1] * 14), 3, 1)],
        "game_id long, team_id long, player_id long, player_name string, start_position string, "
        f"comment string, min string, {counters}, pts int, plus_minus int")
    games = spark.createDataFrame([(1, D(2023, 1, 1), 2022, 1)], "game_id long, game_date_est date, season int, home_team_id long")
    r = facts.build_fact(details, games).collect()[0]
    assert r["m_minutes"] is None
    assert r["dim_did_not_play"] is False and r["dim_is_playing_at_home"] is True


def test_dedup_total_order(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (2, 5, None)], "k int, team_id int, x string")
    got = sorted(facts.dedup(df, ["k"], order=["team_id", "x"]).collect())
    assert got == [Row(k=1, team_id=1, x="a"), Row(k=2, team_id=5, x=None)]


def test_referrer_rules_first_match(spark):
    df = spark.createDataFrame([("https://reddit.com/r/x",), ("https://www.linkedin.com",), (None,),
                                ("https://blog.example.org",), ("https://alpha.shop.example/x",)], "referrer string")
    got = [r[0] for r in df.select(pg.referrer_class("referrer")).collect()]
    # '%t.co%' also matches reddit.com and is tested first
    assert got == ["Twitter", "Linkedin", "Direct", "Other", "On-site"]
    own = pg.referrer_rules(("%blog.example%",))
    assert [r[0] for r in df.select(pg.referrer_class("referrer", own)).collect()][3] == "On-site"


def test_grouping_sets_totals_agree(spark, sf_dir):
    from snapfold.sources import fixtures as fx
    out = cubes.web_dashboard(fx.fx_events(spark, sf_dir), fx.fx_devices(spark, sf_dir), "sets", None)
    rows = out.collect()
    grand = [r for r in rows if (r.referrer, r.browser_type, r.os_type) == ("(overall)",) * 3][0]
    for dim in ("referrer", "browser_type", "os_type"):
        one = [r for r in rows if getattr(r, dim) != "(overall)" and
               sum(getattr(r, d) == "(overall)" for d in ("referrer", "browser_type", "os_type")) == 2]
        assert sum(r.number_of_site_hits for r in one) == grand.number_of_site_hits
    rollup = {(r.referrer, r.browser_type, r.os_type) for r in
              cubes.web_dashboard(fx.fx_events(spark, sf_dir), fx.fx_devices(spark, sf_dir), "rollup", None).collect()}
    cube = {(r.referrer, r.browser_type, r.os_type) for r in
            cubes.web_dashboard(fx.fx_events(spark, sf_dir), fx.fx_devices(spark, sf_dir), "cube", None).collect()}
    assert rollup <= cube


def test_points_rank_ties(spark):
    details = spark.createDataFrame([("a", "T1", 10), ("b", "T1", 10), ("c", "T2", 5)],
                                    "player_name string, team_abbreviation string, pts int")
    seasons = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "player_name string, season int")
    rows = cubes.points_sets(details.withColumn("season", F.lit(1)), seasons, fixed=True).collect()
    by_player = {r.player_name: r.rank_in_group for r in rows if r.player_name and r.team_abbreviation is None}
    assert by_player == {"a": 1, "b": 1, "c": 3}


def test_rolling_top1_tie_break(spark):
    rows = [("T2", g, 1, 1) for g in range(3)] + [("T1", g, 1, 1) for g in range(3)]
    df = spark.createDataFrame(rows, "team_abbreviation string, game_id long, player_id long, plus_minus int")
    win = F.when(F.col("plus_minus") > 0, 1).otherwise(0)
    r = sequences.rolling_sum_top(df, "team_abbreviation", ["game_id", "player_id", "plus_minus"], win, n=2,
                                  bucket_size=2).collect()
    assert [tuple(x) for x in r] == [("T1", 2)]


def test_longest_streak_without_game_ids(spark):
    """NULL game ids come last, join a run and are not counted; one key, top one."""
    rows = [("p", g, pts) for g, pts in [(1, 20), (2, 20), (3, 5), (4, 20), (None, 20)]] + [("q", 1, 50)]
    df = spark.createDataFrame(rows, "player_name string, game_id long, pts int")
    out = "longest_streak_with_10_or_more_pts"
    for size in (1, 2, 4096):
        streak = lambda **k: sequences.longest_streak(df, "player_name", ["game_id", "pts"], F.col("pts") > 10,
                                                      bucket_size=size, **k).collect()
        assert {r["player_name"]: r[out] for r in streak()} == {"p": 2, "q": 1}
        assert [(r["player_name"], r[out]) for r in streak(top=1)] == [("p", 2)]
        assert [(r["player_name"], r[out]) for r in streak(only="q")] == [("q", 1)]


def test_points_ranks_as_written_with_null_totals(spark):
    details = spark.createDataFrame([("a", "T1", 10), ("b", "T1", None), ("c", "T1", 30), ("d", None, 4), ("e", None, None)],
                                    "player_name string, team_abbreviation string, pts int")
    seasons = spark.createDataFrame([(p, s) for p in "abcde" for s in (1, 2)], "player_name string, season int")
    out = cubes.points_sets(details, seasons)
    rows = out.withColumn("want", F.rank().over(Window.partitionBy("season", "team_abbreviation")
                                                .orderBy(F.col("total_points").desc_nulls_first()))).collect()
    teams = [r for r in rows if r.player_name is None and r.team_abbreviation and r.season]
    assert len(teams) == 2 and all(r.rank_in_group == r.want == 2 for r in teams)   # after the NULL total of b


def test_longest_streak_null_breaks(spark):
    rows = [("p", g, pts) for g, pts in [(1, 11), (2, 12), (3, None), (4, 20), (5, 30), (6, 40), (7, 5)]]
    df = spark.createDataFrame(rows, "player_name string, game_id long, pts int")
    r = sequences.longest_streak(df, "player_name", ["game_id", "pts"], F.col("pts") > 10, bucket_size=2).collect()
    assert r[0]["longest_streak_with_10_or_more_pts"] == 3


def _random_events(n=300, seed=7):
    import random
    rnd = random.Random(seed)
    base = dt.datetime(2023, 1, 1, 23, 0)
    return [(rnd.choice([1, 2, 3, None]), base + dt.timedelta(seconds=rnd.randrange(0, 7200)),
             rnd.choice(["/a", "/b", "/c", "/d"])) for _ in range(n)]


def _busy_events(n=400):
    """A user with most events, few of them at an instant of its own, some without a url."""
    import random
    rnd = random.Random(11)
    base = dt.datetime(2023, 1, 1, 8, 0)
    return [(rnd.choice([1, 1, 1, 1, 2]), base + dt.timedelta(seconds=rnd.randrange(0, 90)),
             rnd.choice(["/a", "/b", None, f"/item/{rnd.randrange(40)}"])) for _ in range(n)]


@pytest.mark.parametrize("bucket_seconds,block,rows", [
    (1, 16, None), (60, 1, None), (86400, 2, None), (60, 16, "random"), (7, 1, "random"), (60, 3, "random"),
    (60, 1, "busy"), (5, 4, "busy")])
def test_page_transitions_equals_pairs(spark, bucket_seconds, block, rows):
    t = lambda h, m: dt.datetime(2023, 1, 1, h, m)
    rows = _random_events() if rows == "random" else _busy_events() if rows == "busy" else [
        (1, t(10, 0), "/a"), (1, t(10, 5), "/b"), (1, t(10, 7), "/a"), (1, t(10, 9), "/b"),
        (2, t(9, 0), "/b"), (2, t(9, 0), "/a"), (None, t(9, 1), "/a")]
    ev = spark.createDataFrame(rows, "user_id int, event_time timestamp_ntz, url string")
    got = {(r.to_url, r.from_url): (r.num_users, r.min_seconds) for r in
           sequences.page_transitions(ev, min_users=None, bucket_seconds=bucket_seconds, block=block).collect()}
    # brute force over all same-day earlier pairs
    exp = {}
    for u1, t1, a in rows:
        best = {}
        for u2, t2, b in rows:
            if u1 is not None and u1 == u2 and t1.date() == t2.date() and t1 > t2:
                best[b] = min(best.get(b, 1e18), (t1 - t2).total_seconds())
        for b, s in best.items():
            exp.setdefault((u1, a, b), s)
            exp[(u1, a, b)] = min(exp[(u1, a, b)], s)
    agg = {}
    for (u, a, b), s in exp.items():
        n, m = agg.get((a, b), (0, 1e18))
        agg[(a, b)] = (n + 1, min(m, s))
    assert got == agg


def test_sessions_gap_boundary(spark):
    t = lambda m: dt.datetime(2023, 1, 1, 10, m)
    ev = spark.createDataFrame([("ip", "h", t(0)), ("ip", "h", t(29)), ("ip", "h", t(59))],
                               "ip string, host string, event_time timestamp_ntz")
    got = sorted((r.session_start.minute, r.num_hits) for r in web.sessions(ev, ["ip", "host"], "30 minutes").collect())
    assert got == [(0, 3)]  # 29 -> 59 is exactly the gap: sessions that touch merge
    ev2 = ev.union(spark.createDataFrame([("ip", "h", dt.datetime(2023, 1, 1, 11, 29, 0, 1))],
                                         "ip string, host string, event_time timestamp_ntz"))
    got2 = sorted((r.session_start.minute, r.num_hits) for r in web.sessions(ev2, ["ip", "host"], "30 minutes").collect())
    assert got2 == [(0, 3), (29, 1)]  # one microsecond past the gap starts a new one


@pytest.mark.parametrize("positions,expected", [(4, 4), (None, 3)])
def test_metric_daily_positions(spark, positions, expected):
    df = spark.createDataFrame([("m", D(2023, 1, 1), [1.0, 2.0, 3.0]), ("m", D(2023, 1, 1), [1.0, 1.0, 1.0])],
                               "metric_name string, month_start date, metric_array array<double>")
    rows = dl.metric_daily(df, positions).collect()
    assert len(rows) == expected
    vals = {r.metric_date.day: r.value for r in rows}
    assert vals[1] == 2.0 and vals[3] == 4.0 and (positions is None or vals[4] is None)


@pytest.mark.parametrize("bucket_size", [1, 3, 1000])
def test_bucketed_moving_sum_equals_window(spark, bucket_size):
    import random
    rnd = random.Random(bucket_size)
    rows = [(rnd.choice(["T1", "T2", "T3"]), rnd.randrange(0, 60), rnd.randrange(0, 5), rnd.randrange(-5, 6))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "team_abbreviation string, game_id long, player_id long, plus_minus int")
    win = F.when(F.col("plus_minus") > 0, 1).otherwise(0)
    order = ["game_id", "player_id", "plus_minus"]
    for n in (1, 7, 90):
        a = sequences.rolling_sum_top(df, "team_abbreviation", order, win, n=n, bucket_size=bucket_size).collect()
        w = (Window.partitionBy("team_abbreviation").orderBy(*[F.col(c).asc_nulls_last() for c in order])
                   .rowsBetween(-(n - 1), 0))
        b = (df.select("team_abbreviation", F.sum(win).over(w).alias("max_wins_in_90_game_stretch"))
               .orderBy(F.desc("max_wins_in_90_game_stretch"), "team_abbreviation").limit(1).collect())
        assert a == b


@pytest.mark.parametrize("bucket_size", [1, 4, 1000])
def test_bucketed_streak_equals_brute_force(spark, bucket_size):
    import random
    rnd = random.Random(bucket_size + 1)
    rows = [(rnd.choice(["p", "q"]), g, rnd.choice([None, 3, 11, 12, 20])) for g in range(80) for _ in (0, 1)
            if rnd.random() < 0.8]
    df = spark.createDataFrame(rows, "player_name string, game_id long, pts int")
    got = {r[0]: r[1] for r in sequences.longest_streak(df, "player_name", ["game_id", "pts"], F.col("pts") > 10,
                                                           bucket_size=bucket_size).collect()}
    exp = {}
    for p in ("p", "q"):
        seq = sorted([(g, v is None, v or 0) for n, g, v in rows if n == p])  # NULLs last
        best = cur = 0
        for _, missing, v in seq:
            cur = cur + 1 if not missing and v > 10 else 0
            best = max(best, cur)
        if best:
            exp[p] = best
    assert got == exp


@pytest.mark.parametrize("bucket_hours", [1, 3, 100000])
def test_bucketed_sessions_equal_session_window(spark, bucket_hours):
    import random
    rnd = random.Random(bucket_hours)
    base = dt.datetime(2023, 1, 1, 20, 0)
    rows = [(rnd.choice(["a", "b"]), rnd.choice(["h1", "h2", None]),
             base + dt.timedelta(minutes=rnd.choice([0, 15, 30, 45]) * rnd.randrange(0, 40)))
            for _ in range(300)]
    ev = spark.createDataFrame(rows, "ip string, host string, event_time timestamp_ntz")
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a = sorted(web.sessions_bucketed(ev, ["ip", "host"], 30, bucket_hours=bucket_hours).collect(), key=key)
    b = sorted(web.sessions(ev, ["ip", "host"], "30 minutes").collect(), key=key)
    assert len(a) > 20 and a == b


def test_metric_array_rerun_and_skip(spark):
    from snapfold.sources.sinks import upsert_frames
    keys = ["user_id", "month_start", "metric_name"]
    daily_rows = {d: spark.createDataFrame([(1, D(2023, 1, d), d * 10)], "user_id int, date date, hits bigint")
                  for d in (1, 2, 3)}

    def run(order, positional):
        state = None
        for d in order:
            rows = dl.append_metric(state, daily_rows[d], D(2023, 1, d), positional=positional)
            state = rows if state is None else upsert_frames(state, rows, keys)
        return state.collect()[0]["metric_array"]

    assert run([1, 2, 3], False) == run([1, 2, 3], True) == [10.0, 20.0, 30.0]
    assert run([1, 2, 2, 3], False) == [10.0, 20.0, 20.0, 30.0]      # as written: a re-run appends
    assert run([1, 2, 2, 3], True) == [10.0, 20.0, 30.0]             # positional: idempotent
    assert run([1, 3], False) == [10.0, 30.0]                        # as written: a skipped day shifts
    assert run([1, 3], True) == [10.0, 0.0, 30.0]


def test_partition_load_equals_keyed_upsert(spark, tmp_path):
    from snapfold.sources.sinks import overwrite_partitions, upsert_frames
    keys = ["user_id", "month_start", "metric_name"]
    state = spark.createDataFrame(
        [(1, D(2023, 1, 1), "site_hits", [1.0]), (2, D(2023, 1, 1), "site_hits", [2.0]),
         (1, D(2022, 12, 1), "site_hits", [9.0]), (1, D(2023, 1, 1), "other", [5.0])],
        "user_id int, month_start date, metric_name string, metric_array array<double>")
    today = spark.createDataFrame([(2, D(2023, 1, 2), 4), (3, D(2023, 1, 2), 6)], "user_id int, date date, hits bigint")
    for positional in (False, True):
        path = str(tmp_path / str(positional))
        rows = dl.append_metric(state, today, D(2023, 1, 2), positional=positional)
        overwrite_partitions(state, path, keys[1:])
        overwrite_partitions(rows, path, keys[1:])
        a = sorted(map(tuple, spark.read.schema(state.schema).parquet(path).select(*state.columns).collect()))
        assert a == sorted(map(tuple, upsert_frames(state, rows, keys).collect()))


def test_daily_load_of_reduced_arrays(spark):
    rows = lambda *r: spark.createDataFrame(r, "host string, date date, hits bigint, unique_visitors bigint")
    day1 = dl.append_reduced(None, rows(("a", D(2023, 1, 1), 5, 2), ("b", D(2023, 1, 1), 1, 1)), D(2023, 1, 1))
    day2 = dl.append_reduced(day1, rows(("a", D(2023, 1, 2), 7, 3), ("c", D(2023, 1, 2), 2, 2)), D(2023, 1, 2))
    assert sorted((r.host, r.hit_array, r.unique_visitors_array) for r in day2.collect()) == [
        ("a", [5, 7], [2, 3]), ("c", [2], [2])]                          # the rows to upsert: b is left alone
    feb = dl.append_reduced(day1, rows(("a", D(2023, 2, 1), 9, 9)), D(2023, 2, 1))
    assert [(r.month, r.hit_array) for r in feb.collect()] == [(D(2023, 2, 1), [9])]


def test_rank_by_counts_equals_rank(spark):
    import random
    from snapfold.functions.ordinals import rank_by_counts
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 1, 2, 2, 3, 5, 8])) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, v int").withColumn("id", F.monotonically_increasing_id())
    got = rank_by_counts(df, ["k"], "v", "r").select("id", "r")
    exp = df.select("id", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc_nulls_first())).alias("r"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_bitmask_of_an_early_start(spark):
    users = spark.createDataFrame([(1, [D(2023, 1, 31), D(2022, 11, 1), D(2022, 12, 31)])], "user_id int, dates_active array<date>")
    mask = lambda fixed: dl.date_bitmask(users, F.lit(D(2023, 1, 31)), F.lit(D(2022, 1, 1)), fixed=fixed).first()
    assert mask(True).bits_sum == 2 ** 31 + 2 ** 0 and mask(False).bits_sum == 2 ** 32 + 2 ** 1


def _random_points(n=300):
    import random
    rnd = random.Random(n)
    details = [(rnd.choice("abcdef"), rnd.choice([1, 2, None]), rnd.choice(["T1", "T2", None]), rnd.choice([-3, 0, 4, 9, None]))
               for _ in range(n)] + [(None, 1, "T1", 5), ("g", 1, None, None), ("g", 2, "T1", -2)]
    seasons = [(p, s) for p in "abcdeg" for s in (1, 2)] + [("a", 1), ("b", None), (None, 1), ("h", 2)]
    return details, seasons


@pytest.mark.parametrize("fixed", [False, True])
def test_points_sets_equal_grouping_sets_and_windows(spark, fixed):
    d, s = _random_points()
    details = spark.createDataFrame(d, "player_name string, season int, team_abbreviation string, pts int")
    seasons = spark.createDataFrame(s, "player_name string, season int")     # repeated, null and unknown ones
    got = cubes.points_sets(details if fixed else details.drop("season"), seasons, fixed=fixed).collect()
    dims, order = ["season", "player_name", "team_abbreviation"], F.col("total_points").desc_nulls_first()
    joined = details.join(seasons, ["player_name", "season"]) if fixed else details.drop("season").join(seasons, "player_name")
    want = joined.groupingSets([[F.col(c) for c in x] for x in (dims, dims[:2], [dims[0], dims[2]], dims[:1], [])], *dims).agg(
        F.sum("pts").alias("total_points"), F.grouping("player_name").alias("p"), F.grouping("team_abbreviation").alias("t"))
    want = want.where("season IS NOT NULL OR (player_name IS NULL AND team_abbreviation IS NULL)")
    place = lambda *by: F.rank().over(Window.partitionBy(*by).orderBy(order))
    if fixed:
        rank = place("season", "p", "t")
    else:
        rank = F.when(F.expr("p + t = 0"), place(*dims)).when(F.expr("p = 0"), place(*dims[:2])) \
            .when(F.expr("t = 0"), place("season", "team_abbreviation"))
    want = want.select(*dims, "total_points", F.when(F.col("season").isNotNull(), rank).cast("bigint").alias("rank_in_group"))
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_fact_of_a_crowded_game(spark):
    from snapfold.functions import hot
    counters = ["fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk", "TO", "pf"]
    lines = [(g, t, p, f"P{p}", None, None, "12:30", *([1] * 14), p, 1)
             for g, t, p in [(1, t, p) for t in (1, 2) for p in range(200)] * 2 + [(g, 1, 1) for g in range(2, 90)] + [(None, 1, 1)]]
    details = spark.createDataFrame(lines, "game_id long, team_id long, player_id long, player_name string, start_position string, "
                                    f"comment string, min string, {', '.join(f'`{c}` int' for c in counters)}, pts int, plus_minus int")
    games = spark.createDataFrame([(g, D(2023, 1, 1), 2022, 1) for g in range(1, 80)],
                                  "game_id long, game_date_est date, season int, home_team_id long")
    _, crowded = hot.split_heavy(details.dropna(subset=["game_id"]), ["game_id"])
    assert [r[0] for r in crowded.select("game_id").distinct().collect()] == [1]
    out = facts.build_fact(details, games)
    assert out.count() == 400 + 78 and out.groupBy("dim_player_id").count().where("dim_player_id = 7").first()[1] == 2


def test_streaks_of_heavy_and_ordinary_keys(spark):
    rows = [("hot", g, 20 if g % 100 else 1) for g in range(400)] + [("p", g, 20) for g in range(5)] + [(None, 1, 20)]
    df = spark.createDataFrame(rows, "player_name string, game_id long, pts int")
    got = {r[0]: r[1] for r in sequences.longest_streak(df, "player_name", ["game_id", "pts"], F.col("pts") > 10,
                                                        bucket_size=7).collect()}
    assert got == {"hot": 99, "p": 5, None: 1}


def test_moving_sum_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(sequences, "ROWS", 4)
    df = spark.createDataFrame([("T1", g, int(g % 5 != 0)) for g in range(40)], "team string, game_id long, won int")
    for n, most in ((1, 1), (3, 3), (4, 4), (6, 5), (90, 32)):
        assert sequences.rolling_sum_top(df, "team", ["game_id"], F.col("won"), n=n, out="m").first()["m"] == most
