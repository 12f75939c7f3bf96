"""Declared tables: inserts by column list, and what breaks a table's declarations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from snapfold.functions.ranges import range_join
from snapfold.operators import cumulative as cu
from snapfold.operators import facts, graph
from snapfold.plans.oracle import oracle
from snapfold.plans.q_cumulative import players_closed_form, players_latest, players_table
from snapfold.plans.q_facts import fact_sql
from snapfold.plans.q_graph import GRAPH_SQL
from snapfold.plans.registry import query
from snapfold.session import cut_lineage, scratch_path
from snapfold.sources import fixtures as fx
from snapfold.sources import schemas, sinks

# what the declared table holds where an insert leaves the column out
PLAYER_DEFAULTS = {"is_active": "false"}


@query("load_insert_columns")
def load_insert_columns(spark, sf_dir):
    """INSERT INTO players (columns) SELECT: the newest snapshot, its columns and the fields
    of its history in another order; ``is_active`` is left out and takes its default."""
    latest = cut_lineage(players_latest(spark, sf_dir), "parquet")
    turned = latest.withColumn("season_stats", F.transform("season_stats", lambda x: F.struct(
        *[x[f].alias(f) for f in reversed(cu.STAT_FIELDS)])))
    columns = [c for c in reversed(schemas.TABLES["players"].names) if c != "is_active"]
    name, path = f"players_{uuid.uuid4().hex}", scratch_path(spark, "players")
    schemas.declare(spark, name, schemas.TABLES["players"], path, PLAYER_DEFAULTS)
    schemas.insert_columns(turned, name, columns, enums={"scoring_class": schemas.ENUMS["scoring_class"]},
                           required=schemas.PRIMARY_KEYS["players"])
    spark.sql(f"DROP TABLE {name}")                     # the catalog entry; the rows stay at the path
    stored = spark.read.schema(schemas.TABLES["players"]).parquet(path)
    return cu.explode_history(stored, keys=["player_name", "college", "draft_number", "scoring_class",
                                            "current_season", "is_active"])


oracle("load_insert_columns", """SELECT player_name, college, draft_number,
       CASE WHEN latest > 20 THEN 'star' WHEN latest > 15 THEN 'good' WHEN latest > 10 THEN 'average' ELSE 'bad' END
         AS scoring_class,
       (SELECT max(season) FROM fx_player_seasons) AS current_season, false AS is_active, season, gp, pts, reb, ast
FROM fx_player_seasons
JOIN (SELECT player_name, arg_max(pts, season) AS latest FROM fx_player_seasons GROUP BY player_name) l USING (player_name)""")


# ---- keys, nulls and enums

def _planted_players(players):
    """The table and rows that break its declarations: the snapshots of players two seasons
    away come again, one draft round of them with an unknown class, another without a name."""
    again = players.where(F.col("years_since_last_season") == 2)
    again = again.withColumn("scoring_class", F.when(F.col("draft_round") == "1", "legend").otherwise(F.col("scoring_class"))) \
        .withColumn("player_name", F.when(F.col("draft_round") != "2", F.col("player_name")))
    return players.unionByName(again)


def _planted_vertices(games):
    """Games with under 40 points at home come again as stadiums, twice, and the vertices of
    home wins by the first team a second time."""
    v = graph.game_vertices(games)
    low = graph.game_vertices(games.where("pts_home < 40")).withColumn("type", F.lit("stadium"))
    return v.unionByName(low).unionByName(low).unionByName(
        graph.game_vertices(games.where("home_team_wins = 1 AND home_team_id = 0")))


@query("constraint_report")
def constraint_report(spark, sf_dir):
    """Violations of the declared keys, not-null columns and enums of three stored tables, two
    with planted breaches; the third is the fact, whose declared key the fixture breaks."""
    games = fx.fx_games(spark, sf_dir)
    stored = {"players": _planted_players(players_table(spark, sf_dir)), "vertices": _planted_vertices(games),
              "fct_game_details": facts.build_fact(fx.fx_game_details(spark, sf_dir), games)}
    out = None
    for name, df in stored.items():
        enums = {c: schemas.ENUMS[e] for c, e in schemas.ENUM_COLUMNS.get(name, {}).items()}
        one = sinks.constraint_report(cut_lineage(df, "parquet"), name, schemas.PRIMARY_KEYS[name], enums=enums)
        out = one if out is None else out.unionByName(one)
    return out


oracle("constraint_report", GRAPH_SQL + f""", snapshots AS (
  SELECT * FROM ({players_closed_form("true")}) h WHERE pos = 0),
away AS (SELECT draft_round FROM snapshots WHERE years_since_last_season = 2),
fact AS ({fact_sql()}),
low AS (SELECT count(*) AS n FROM fx_games WHERE pts_home < 40),
home AS (SELECT count(*) AS n FROM fx_games WHERE home_team_wins = 1 AND home_team_id = 0)
SELECT 'players' AS table_name, 'not null' AS constraint_type, 'player_name' AS columns,
       count(*) FILTER (draft_round = '2') AS violations FROM away
UNION ALL SELECT 'players', 'not null', 'current_season', 0
UNION ALL SELECT 'players', 'enum', 'scoring_class', count(*) FILTER (draft_round = '1') FROM away
UNION ALL SELECT 'players', 'primary key', 'player_name, current_season', count(*) FILTER (draft_round <> '2') FROM away
UNION ALL SELECT 'vertices', 'not null', unnest(['identifier', 'type']), 0
UNION ALL SELECT 'vertices', 'enum', 'type', 2 * n FROM low
UNION ALL SELECT 'vertices', 'primary key', 'identifier, type', low.n + home.n FROM low, home
UNION ALL SELECT 'fct_game_details', 'not null', unnest(['dim_game_date', 'dim_team_id', 'dim_player_id']), 0
UNION ALL SELECT 'fct_game_details', 'primary key', 'dim_game_date, dim_team_id, dim_player_id',
       (SELECT count(*) FROM fact) - (SELECT count(*) FROM (SELECT DISTINCT dim_game_date, dim_team_id, dim_player_id FROM fact) k)""")


# ---- range join

@query("season_calendar_join")
def season_calendar_join(spark, sf_dir):
    """Each player with every season of the calendar between the first and the last one they
    played: ``first_season <= season AND season <= last_season``."""
    played = cut_lineage(fx.fx_player_seasons(spark, sf_dir).groupBy("player_name").agg(
        F.min("season").alias("first_season"), F.max("season").alias("last_season")), "parquet")
    calendar = cut_lineage(fx.fx_player_seasons(spark, sf_dir).select("season").distinct(), "parquet")
    return range_join(calendar, played, "season", "first_season", "last_season") \
        .select("player_name", "first_season", "last_season", "season")


oracle("season_calendar_join", """SELECT player_name, first_season, last_season, season
FROM (SELECT player_name, min(season) AS first_season, max(season) AS last_season FROM fx_player_seasons GROUP BY player_name) p
JOIN (SELECT DISTINCT season FROM fx_player_seasons) c ON season BETWEEN first_season AND last_season""")
