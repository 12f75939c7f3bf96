from __future__ import annotations

from pyspark.sql import functions as F

from snapfold.operators import facts
from snapfold.plans.oracle import oracle
from snapfold.plans.registry import query
from snapfold.sources import fixtures as fx

DETAIL_COLUMNS = ["game_id", "team_id", "team_abbreviation", "player_id", "player_name",
                  "start_position", "comment", "min", *fx.SMALL_COUNTERS, "pts", "plus_minus"]


def _order_sql(keys):
    rest = [c for c in DETAIL_COLUMNS if c not in keys]
    return ", ".join(f'"{c}" ASC NULLS FIRST' for c in facts.total_order(rest))


@query("dedup_game_details")
def dedup_game_details(spark, sf_dir):
    return facts.dedup(fx.fx_game_details(spark, sf_dir), ["game_id"])


oracle("dedup_game_details", f"""SELECT DISTINCT ON (game_id) * FROM fx_game_details
ORDER BY game_id, {_order_sql(["game_id"])}""")


@query("duplicate_report")
def duplicate_report(spark, sf_dir):
    return facts.find_duplicates(fx.fx_game_details(spark, sf_dir), ["game_id", "team_id", "player_id"])


oracle("duplicate_report", """SELECT game_id, team_id, player_id, COUNT(1) AS num_rows
FROM fx_game_details GROUP BY 1, 2, 3 HAVING COUNT(1) > 1""")


def _fact(spark, sf_dir, fixed=False):
    return facts.build_fact(fx.fx_game_details(spark, sf_dir), fx.fx_games(spark, sf_dir),
                            fixed_minutes=fixed)


query("fct_game_details")(lambda spark, sf_dir: _fact(spark, sf_dir))
query("fct_game_details_fixed")(lambda spark, sf_dir: _fact(spark, sf_dir, fixed=True))


FACT_KEYS = ["game_id", "team_id", "player_id"]
# target column: its source expression over one line of a player in a game
_CLOCK = """string_split("min", ':')"""
_MEASURES = {"turnovers": '"TO"', **{c: c for c in ("fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb",
                                                   "ast", "stl", "blk", "pf", "pts", "plus_minus")}}
_REASONS = {"did_not_play": "DNP", "did_not_dress": "DND", "not_with_team": "NWT"}


def fact_sql(fixed: bool = False) -> str:
    whole, part = (f"TRY_CAST({_CLOCK}[{i}] AS DOUBLE)" for i in (1, 2))
    minutes = f"{whole} + {part} / 60" if fixed else f"({whole} + {part}) / 60"
    columns = {"dim_game_date": "game_date_est::TIMESTAMP", "dim_season": "season", "dim_team_id": "team_id",
               "dim_player_id": "player_id", "dim_player_name": "player_name", "dim_start_position": "start_position",
               "dim_is_playing_at_home": "team_id = home_team_id",
               **{f"dim_{k}": f"coalesce(contains(comment, '{v}'), false)" for k, v in _REASONS.items()},
               "m_minutes": minutes, **{f"m_{k}": v for k, v in _MEASURES.items()}}
    listed = ", ".join(f"{v} AS {k}" for k, v in columns.items())
    keys = ", ".join(FACT_KEYS)
    return f"""SELECT {listed}
FROM (SELECT DISTINCT ON ({keys}) * FROM fx_games JOIN fx_game_details d USING (game_id)
      ORDER BY {keys}, game_date_est, {_order_sql(FACT_KEYS)}) line"""


oracle("fct_game_details", fact_sql())
oracle("fct_game_details_fixed", fact_sql(fixed=True))


@query("fact_join_team")
def fact_join_team(spark, sf_dir):
    f = _fact(spark, sf_dir)
    t = fx.fx_teams(spark, sf_dir)
    return t.join(f, t.team_id == f.dim_team_id).select(*[t[c] for c in t.columns], *[f[c] for c in f.columns])


oracle("fact_join_team", f"""WITH fct AS ({fact_sql()})
SELECT t.*, gd.* FROM fct gd JOIN fx_teams t ON t.team_id = gd.dim_team_id""")


@query("bail_rate")
def bail_rate(spark, sf_dir):
    return facts.rate(_fact(spark, sf_dir), "dim_player_name", "dim_not_with_team") \
        .orderBy(F.desc_nulls_first("bail_pct"), "dim_player_name")


oracle("bail_rate", f"""WITH fct AS ({fact_sql()})
SELECT dim_player_name, COUNT(1) AS num_games,
       COUNT(CASE WHEN dim_not_with_team THEN 1 END) AS bailed_num,
       CAST(COUNT(CASE WHEN dim_not_with_team THEN 1 END) AS DOUBLE) / COUNT(1) AS bail_pct
FROM fct GROUP BY 1""")
