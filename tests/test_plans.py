"""Physical plans: no Cartesian products, no Python UDFs, pushdown and pruning."""
from __future__ import annotations

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from snapfold.operators import datelists as dl
from snapfold.plans.registry import load_all
from snapfold.sources import fixtures as fx
from snapfold.sources.tables import read_table

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
QUERIES = load_all()
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_or_python(spark, sf_dir, name):
    text = plan_text(QUERIES[name](spark, sf_dir))
    for op in FORBIDDEN:
        assert op not in text, f"{name}: {op} in plan"


def test_day_filter_reaches_the_scan(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").withColumnRenamed("ts", "event_time")
    text = plan_text(ev.where(dl.day_range("event_time", dt.date(2024, 1, 3))).select("user_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_pages_scan_is_pruned(spark, sf_dir):
    text = plan_text(fx.fx_events(spark, sf_dir))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in text  # html is never read


def test_dedup_is_an_aggregate(spark, sf_dir):
    from snapfold.operators.facts import dedup
    text = plan_text(dedup(fx.fx_game_details(spark, sf_dir), ["game_id"]))
    assert "HashAggregate" in text or "ObjectHashAggregate" in text or "SortAggregate" in text
    assert "Window" not in text


def test_bitmask_has_no_shuffle_beyond_the_list(spark, sf_dir):
    from snapfold.plans.q_datelists import daily
    users = daily(spark, sf_dir).groupBy("user_id").agg(F.collect_set("date").alias("dates_active"))
    text = plan_text(dl.date_bitmask(users, F.lit(dt.date(2024, 1, 30)), F.lit(dt.date(2024, 1, 1))))
    assert "Expand" not in text and "Generate" not in text   # no users x days expansion


def shuffles(df) -> int:
    """Shuffles that the query ran; what one reuses is not counted again."""
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum("Exchange" in line and "Reused" not in line and "Broadcast" not in line for line in ran.splitlines())


@pytest.mark.parametrize("name, most", [("session_avg", 8), ("session_avg_by_host", 9), ("session_filter", 14),
                                        ("page_transitions", 8), ("rolling_wins", 5)])
def test_shuffles_of_bucketed_windows(spark, sf_dir, name, most):
    assert shuffles(QUERIES[name](spark, sf_dir)) <= most


def test_moving_sum_has_no_self_join(spark, sf_dir):
    text = plan_text(QUERIES["rolling_wins"](spark, sf_dir))
    tree = text.split("== Physical Plan ==")[1].split("\n\n")[0]
    assert sum("Join" in line for line in tree.splitlines()) == 1      # the bucket offsets


def test_host_condition_is_below_the_sessions(spark, sf_dir):
    from snapfold.plans import q_web
    seen = []
    old = q_web.cut_lineage
    q_web.cut_lineage = lambda df, *a: seen.append(df) or old(df, *a)
    try:
        QUERIES["session_avg"](spark, sf_dir)
    finally:
        q_web.cut_lineage = old
    assert {r.host for r in seen[0].select("host").distinct().collect()} == {
        r.host for r in seen[0].where(F.col("host").like(q_web.HOST_LIKE)).select("host").distinct().collect()}


def test_hosts_filter_is_pushed(spark, sf_dir):
    ev = fx.fx_events(spark, sf_dir)
    text = plan_text(ev.where(dl.before_day("event_time", dt.date(2024, 1, 3))).select("host"))
    assert "LessThan(ts," in text


@pytest.mark.parametrize("name", ["fct_game_details", "fct_game_details_fixed", "fact_join_team"])
def test_fact_lines_are_shuffled_once(spark, sf_dir, name):
    tree = plan_text(QUERIES[name](spark, sf_dir)).split("\n\n")[0]
    assert tree.count("Union") == 1 and tree.count("SortAggregate") == 2
    below = tree.split("SortAggregate", 1)[1].split("Union")[0]      # from the lines' aggregate down to their scans
    assert below.count("Exchange") == 1
    assert "Exchange" not in below.split("SortAggregate", 1)[0]      # no combining, so no sort, before the shuffle


def test_streak_is_one_window_per_ordinary_key(spark, sf_dir):
    tree = plan_text(QUERIES["longest_streak_top"](spark, sf_dir)).split("\n\n")[0]
    assert tree.count("Window") == 1 and tree.count("Exchange") == 1 and "Join" not in tree


def test_moving_sum_keeps_no_table_of_sums(spark, sf_dir):
    tree = plan_text(QUERIES["rolling_wins"](spark, sf_dir)).split("\n\n")[0]
    above = tree.split("Join")[0]                                    # what happens to the numbered rows
    assert above.count("Aggregate") == 2 and above.count("Window") == 1   # the best of each team only


@pytest.mark.parametrize("name", ["points_grouping_sets", "points_grouping_sets_fixed"])
def test_points_rows_are_not_expanded(spark, sf_dir, name):
    tree = plan_text(QUERIES[name](spark, sf_dir)).split("\n\n")[0]
    for below in tree.split("Expand")[1:]:                           # a set is summed from the stored counts
        assert "Join" not in below.split("Scan")[0]
