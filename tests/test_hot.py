"""Joins with crowded keys, and the range join, against brute force."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from snapfold.functions import hot
from snapfold.functions.ranges import range_join
from snapfold.session import cut_lineage
from tests.test_plans import plan_text


def test_heavy_keys_are_few_and_exact(spark):
    df = spark.createDataFrame([(k if k < 50 else 7,) for k in range(2000)] + [(None,)] * 900, "k int")
    got = hot.heavy_keys(df, ["k"], least=10, share=100).collect()
    assert [tuple(r) for r in got] == [(7, 1951)]
    assert hot.heavy_keys(df.where("k < 7"), ["k"]) is None


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_unique_equals_a_join(spark, how):
    rows = [(3 if i % 3 else i % 40, i) for i in range(900)] + [(None, 1), (None, 2)]
    big = spark.createDataFrame(rows, "k int, v int")
    small = spark.createDataFrame([(k, f"s{k}") for k in range(0, 40, 2)] + [(3, "three")], "k int, s string")
    want = sorted(big.join(small, ["k"], how).collect(), key=str)
    counts = big.dropna().groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for given in (None, counts):
        got = hot.join_unique(big, small, ["k"], how, least=50, share=20, counts=given)
        assert sorted(got.collect(), key=str) == want


def test_grid_join_makes_each_pair_once(spark):
    rnd = random.Random(1)
    rows = lambda n, x: [(rnd.choice([1, 1, 1, 2, 3, None]), f"{x}{i}") for i in range(n)]
    a = spark.createDataFrame(rows(200, "a"), "k int, a string")
    b = spark.createDataFrame(rows(150, "b"), "k int, b string")
    got = hot.grid_join(a, b, ["k"], [F.col("a")], [F.col("b")], block=16, share=4)
    assert sorted(got.collect()) == sorted(a.join(b, ["k"]).collect())


def test_a_crowded_game_is_dealt_to_many_tasks(spark):
    """One game holds a third of all rows: its pairs lie in cells of a bounded number of rows,
    and no task has over twice the median of the pairs."""
    n = 3000
    rows = [(i, 0 if i % 3 == 0 else 1 + i // 6) for i in range(n)]
    lines = cut_lineage(spark.createDataFrame(rows, "p long, game long"), "parquet")
    side = lambda x: lines.select("game", F.col("p").alias(x))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")        # no help from skew splitting
    try:
        got = hot.grid_join(side("a"), side("b"), ["game"], [F.col("a")], [F.col("b")], block=64)
        tasks = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
        spark.conf.set("spark.sql.adaptive.enabled", old[1])
    assert sum(tasks) == sum(len([1 for _, g in rows if g == game]) ** 2 for game in {g for _, g in rows})
    assert tasks[-1] <= 2 * tasks[len(tasks) // 2]
    size = hot.cells(side("a"), side("b"), ["game"], 64).collect()
    assert [tuple(r) for r in size] == [(0, 16, 16)]


def test_range_join_against_brute_force(spark):
    rnd = random.Random(5)
    inf, nan = float("inf"), float("nan")
    points = [(i, rnd.choice([rnd.uniform(-50, 50), rnd.randint(-9, 9) * 1.0])) for i in range(120)]
    points += [(500, None), (501, nan), (502, inf), (503, -inf), (504, 1e300), (505, 0.0), (505, 0.0)]
    ranges = [(i, x, x + rnd.choice([0.0, 0.3, 4.0, 25.0, -1.0])) for i in range(80) for x in [float(rnd.randint(-50, 50))]]
    ranges += [(900, -1e12, 1e12), (901, -inf, inf), (902, None, 3.0), (903, 1.0, None), (904, nan, nan), (905, 3.0, inf),
               (906, 0.0, 0.0), (907, -1e300, 1e300), (908, 2.0, 1.0)]
    p = spark.createDataFrame(points, "i int, x double")
    r = spark.createDataFrame(ranges, "j int, lo double, hi double")
    want = sorted((i, j) for i, x in points for j, lo, hi in ranges
                  if None not in (x, lo, hi) and x == x and lo == lo and hi == hi and lo <= x <= hi)
    for block in (8, 1024):
        got = range_join(p, r, "x", "lo", "hi", block=block)
        assert got.columns == ["i", "x", "j", "lo", "hi"]
        assert sorted((g.i, g.j) for g in got.collect()) == want
    assert range_join(p.limit(0), r, "x", "lo", "hi").count() == range_join(p, r.limit(0), "x", "lo", "hi").count() == 0


def test_range_join_with_keys_and_without_a_nested_loop(spark):
    p = spark.createDataFrame([(k % 3, k) for k in range(60)] + [(None, 5)], "k int, x long")
    r = spark.createDataFrame([(0, 3, 40), (1, 10, 10), (2, 50, 10**15), (None, 0, 99)], "k int, lo long, hi long")
    got = range_join(p, r, "x", "lo", "hi", keys=["k"])
    assert sorted((g.k, g.x) for g in got.collect()) == sorted(
        (k % 3, k) for k in range(60) if (3 <= k <= 40 and k % 3 == 0) or k == 10 or (k >= 50 and k % 3 == 2))
    text = plan_text(got)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_split_heavy_parts_share_no_key(spark):
    rows = [(k if k < 900 else 7,) for k in range(2000)] + [(None,)] * 900
    df = spark.createDataFrame(rows, "k int")
    light, heavy = hot.split_heavy(df, ["k"], least=10, share=100)
    a, b = ({r[0] for r in part.distinct().collect()} for part in (light, heavy))
    assert {7, None} <= b and not a & b and light.count() + heavy.count() == len(rows)
    assert light.groupBy("k").count().agg(F.max("count")).first()[0] <= 29
    assert hot.split_heavy(df.where("k < 7"), ["k"])[1] is None
