"""Fixture views reproduce the figures FIXTURES.md states."""
from __future__ import annotations

from pyspark.sql import functions as F

from snapfold.functions.pgcompat import score_class
from snapfold.sources import fixtures as fx

SF01 = "/root/testdata/sf0.01"


def test_player_season_classes(spark):
    ps = fx.fx_player_seasons(spark, SF01)
    got = {r[0]: r[1] for r in ps.groupBy(score_class("pts").alias("c")).count().collect()}
    assert ps.count() == 7895
    assert got == {"star": 961, "good": 1763, "average": 2469, "bad": 2702}


def test_natural_duplicates(spark, sf_dir):
    for d, n in ((sf_dir, 8), (SF01, 6)):
        base = fx.fx_details_base(spark, d)
        dups = base.groupBy("game_id", "team_id", "player_id").count().where("count > 1").count()
        assert dups == n


def test_events_view(spark, sf_dir):
    ev = fx.fx_events(spark, sf_dir)
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert ev.count() == raw.where(F.col("user_id").isNotNull()).count()
    assert set(r[0] for r in ev.select("host").distinct().collect()) == set(fx.HOSTS)
    nulls = ev.where(F.col("user_id").isNull()).count()
    assert nulls == raw.where((F.col("event_id") % 97 == 0) & F.col("user_id").isNotNull()).count()


def test_sizes(spark, sf_dir):
    assert fx.fx_actor_films(spark, sf_dir).count() == 1500
    assert fx.fx_games(spark, sf_dir).count() == 1500
    assert fx.fx_details_base(spark, sf_dir).count() == 6000
