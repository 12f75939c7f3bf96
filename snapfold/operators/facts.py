"""Deduplication, duplicate audit and the star-schema game fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.functions.hot import split_heavy

# Tie-break of rows that share the dedup key: these columns first, then every
# other column, all ascending with NULLs first.
DETAIL_ORDER = ("team_id", "player_id", "start_position", "pts", "min", "comment", "plus_minus")


def total_order(columns: list[str], leading=DETAIL_ORDER) -> list[str]:
    lead = [c for c in leading if c in columns]
    return lead + [c for c in columns if c not in lead]


def dedup(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Keep the first row per ``keys`` in ``order`` (ascending, NULLs first),
    the ``row_number() = 1`` pattern with a total order.

    Written as ``min(struct(order...))`` per key: the minimum is combined
    map-side, so a key that holds a third of the rows is reduced before the
    shuffle instead of being sorted in one task."""
    rest = [c for c in df.columns if c not in keys]
    order = total_order(rest, order or DETAIL_ORDER)
    picked = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in order])).alias("_row"))
    return picked.select(*[F.col(k) for k in keys], *[F.col(f"_row.{c}").alias(c) for c in rest]) \
                 .select(*df.columns)


def find_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Groups of ``keys`` with more than one row."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_rows"))
              .where(F.col("num_rows") > 1))


# Marker texts in the comment column.
DNP, DND, NWT = "DNP", "DND", "NWT"
# game_details counters -> fact measure names
MEASURES = (("fgm", "m_fgm"), ("fga", "m_fga"), ("fg3m", "m_fg3m"), ("fg3a", "m_fg3a"),
            ("ftm", "m_ftm"), ("fta", "m_fta"), ("oreb", "m_oreb"), ("dreb", "m_dreb"),
            ("reb", "m_reb"), ("ast", "m_ast"), ("stl", "m_stl"), ("blk", "m_blk"),
            ("TO", "m_turnovers"), ("pf", "m_pf"), ("pts", "m_pts"), ("plus_minus", "m_plus_minus"))


def _contains(c: str, marker: str):
    return F.coalesce(F.position(F.lit(marker), F.col(c)), F.lit(0)) > 0


def build_fact(details: DataFrame, games: DataFrame, fixed_minutes: bool = False) -> DataFrame:
    """``fct_game_details``: one row per (game, team, player) with the game's
    date, season and home flag, DNP/DND/NWT flags and minutes.

    Dedup happens before the join (every row of a game has the same game
    date, the reference's ordering key), which shrinks the join input. The lines are
    shuffled and sorted once, by game, for both; those of crowded games are combined
    before their shuffle instead (``dedup``), so no task holds such a game."""
    line = ["game_id", "team_id", "player_id"]
    g = games.select("game_id", "game_date_est", "season", "home_team_id")
    rest, crowded = split_heavy(details.dropna(subset=["game_id"]), ["game_id"])
    j = dedup(rest.repartition("game_id"), line).join(g, "game_id")
    if crowded is not None:
        j = j.unionByName(dedup(crowded, line).join(g, "game_id"))
    mins = F.split_part(F.col("min"), F.lit(":"), F.lit(1)).try_cast("double")
    secs = F.split_part(F.col("min"), F.lit(":"), F.lit(2)).try_cast("double")
    minutes = mins + secs / 60 if fixed_minutes else (mins + secs) / 60
    return j.select(
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        _contains("comment", DNP).alias("dim_did_not_play"),
        _contains("comment", DND).alias("dim_did_not_dress"),
        _contains("comment", NWT).alias("dim_not_with_team"),
        minutes.alias("m_minutes"),
        *[F.col(src).alias(dst) for src, dst in MEASURES],
    )


def rate(df: DataFrame, key: str, flag: str, n_name="num_games", k_name="bailed_num",
         pct_name="bail_pct") -> DataFrame:
    """Per key: rows, rows with ``flag`` true, and their share."""
    n = F.count(F.lit(1))
    k = F.count(F.when(F.col(flag), 1))
    return df.groupBy(key).agg(n.alias(n_name), k.alias(k_name), (k.cast("double") / n).alias(pct_name))
