"""A property graph held as two DataFrames.

vertices(identifier, type, properties JSON) and
edges(subject_identifier, subject_type, object_identifier, object_type,
edge_type, properties JSON). Graph questions are joins and aggregations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.functions.hot import BLOCK, grid_join
from snapfold.functions.pgcompat import safe_divisor
from snapfold.operators.facts import dedup

JSON_OPTS = {"ignoreNullFields": "false"}  # json_build_object keeps NULL members


def json_object(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), JSON_OPTS)


def _vertex(identifier: Column, vtype: str, props: Column) -> list[Column]:
    return [identifier.cast("string").alias("identifier"), F.lit(vtype).alias("type"),
            props.alias("properties")]


def game_vertices(games: DataFrame) -> DataFrame:
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    # the member name keeps the source's spelling
    return games.select(*_vertex(F.col("game_id"), "game",
                                 json_object(F.col("pts_home"), F.col("pts_away"),
                                             winner.alias("wininning_team"))))


def player_vertices(details: DataFrame) -> DataFrame:
    """Games, points and distinct teams per player; the per-player team set is
    combined map-side (collect_set), so a busy player never ships raw rows."""
    agg = details.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"),
        F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").cast("bigint").alias("total_points"),
        F.array_sort(F.collect_set("team_id")).alias("teams"))
    return agg.select(*_vertex(F.col("player_id"), "player",
                               json_object(*[F.col(c) for c in ("player_name", "number_of_games",
                                                                 "total_points", "teams")])))


def team_vertices(teams: DataFrame) -> DataFrame:
    t = dedup(teams, ["team_id"], order=["abbreviation", "nickname", "city", "arena", "yearfounded"])
    return t.select(*_vertex(F.col("team_id"), "team",
                             json_object(F.col("abbreviation"), F.col("nickname"), F.col("city"),
                                         F.col("arena"), F.col("yearfounded").alias("year_founded"))))


def player_game_rows(details: DataFrame) -> DataFrame:
    """One row per (player, game), the ``row_number() = 1`` dedup with a total
    order. Both kinds of edges start from it: store it once."""
    cols = ["player_id", "game_id", "team_id", "team_abbreviation", "player_name", "start_position", "pts"]
    return dedup(details.select(*cols), ["player_id", "game_id"])


def plays_in_edges(lines: DataFrame) -> DataFrame:
    """One edge per row of ``player_game_rows``."""
    return lines.select(
        F.col("player_id").cast("string").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("game_id").cast("string").alias("object_identifier"), F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"),
        json_object(F.col("start_position"), F.col("pts"), F.col("team_id"),
                    F.col("team_abbreviation")).alias("properties"))


def player_edges(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """Player-player edges: per ordered pair (subject id > object id) of
    players in the same game, ``shares_team`` or ``plays_against``, with games
    and both players' points.

    The pairs are the output itself, so the game self-join stays: ``lines`` is
    one narrow stored row per (player, game) (``player_game_rows``). A game with
    over ``block`` rows is cut into a grid (``hot.grid_join``), so that a task holds
    a block of its pairs, not the game."""
    f = lines.select("player_id", "game_id", "player_name", "team_abbreviation", "pts")
    side = lambda x: f.select("game_id", *[F.col(c).alias(f"{x}_{c}") for c in f.columns if c != "game_id"])
    pairs = grid_join(side("a"), side("b"), ["game_id"], [F.col("a_player_id")], [F.col("b_player_id")], block).where(
        (F.col("a_player_name") != F.col("b_player_name")) & (F.col("a_player_id") > F.col("b_player_id")))
    etype = (F.when(F.col("a_team_abbreviation") == F.col("b_team_abbreviation"), F.lit("shares_team"))
              .otherwise(F.lit("plays_against")))
    agg = pairs.groupBy(F.col("a_player_id").alias("s"), F.col("b_player_id").alias("o"),
                        etype.alias("edge_type")).agg(
        F.max("a_player_name").alias("subject_player_name"),
        F.max("b_player_name").alias("object_player_name"),
        F.count(F.lit(1)).alias("num_games"),
        F.sum("a_pts").cast("bigint").alias("subject_points"),
        F.sum("b_pts").cast("bigint").alias("object_points"))
    return agg.select(
        F.col("s").cast("string").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("o").cast("string").alias("object_identifier"), F.lit("player").alias("object_type"),
        "edge_type",
        json_object(F.col("num_games"), F.col("subject_points"), F.col("object_points")).alias("properties"))


def vertex_counts(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy("type").agg(F.count(F.lit(1)).alias("num_vertices"))


def max_edge_points(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Largest ``pts`` on any edge leaving each player vertex, by player name.
    The edges are reduced to one row per subject before they meet the vertices."""
    most = edges.groupBy("subject_identifier", "subject_type").agg(
        F.max(F.get_json_object("properties", "$.pts").cast("int")).alias("pts"))
    v = vertices.select("identifier", "type", F.get_json_object("properties", "$.player_name").alias("player_name"))
    j = v.join(most, (v.identifier == most.subject_identifier) & (v.type == most.subject_type))
    return j.groupBy("player_name").agg(F.max("pts").alias("max_pts"))


def pair_report(vertices: DataFrame, edges: DataFrame, fixed: bool = False) -> DataFrame:
    """Per player-player edge: the subject's career ratio, and the points and
    games against the object. As written the ratio is games / points (0 -> 1);
    ``fixed`` gives points per game. The JSON of each side is parsed once,
    before the join."""
    v = vertices.select("identifier", "type", F.from_json(
        "properties", "player_name string, number_of_games double, total_points double").alias("v"))
    num, den = ("v.total_points", "v.number_of_games") if fixed else ("v.number_of_games", "v.total_points")
    v = v.select("identifier", "type", "v.player_name",
                 (F.col(num) / safe_divisor(den)).alias("pct_point_per_game_career")) \
        .where(F.col("pct_point_per_game_career").isNotNull())
    e = edges.where(F.col("object_type") == "player").select(
        "subject_identifier", "subject_type", "object_identifier",
        F.from_json("properties", "subject_points string, num_games string").alias("e"))
    return (v.join(e, (v.identifier == e.subject_identifier) & (v.type == e.subject_type))
             .select("player_name", "object_identifier", "pct_point_per_game_career",
                     F.col("e.subject_points").alias("total_points_scores_vs_object"),
                     F.col("e.num_games").alias("games_played")))
