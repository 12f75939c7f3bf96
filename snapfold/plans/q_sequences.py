from __future__ import annotations

from pyspark.sql import functions as F

from snapfold.operators import cubes, sequences
from snapfold.plans.oracle import oracle
from snapfold.plans.q_cubes import MIN_HITS
from snapfold.plans.q_facts import _order_sql
from snapfold.plans.registry import query
from snapfold.sources import fixtures as fx

WINDOW_ROWS = 90
# total order of a team's rows: rows equal on all three have the same win flag
ROLLING_ORDER = ["game_id", "player_id", "plus_minus"]


def _win():
    return F.when(F.col("plus_minus").cast("int") > 0, 1).otherwise(0)


@query("rolling_wins")
def rolling_wins(spark, sf_dir):
    return sequences.rolling_sum_top(fx.fx_game_details(spark, sf_dir), "team_abbreviation",
                                     ROLLING_ORDER, _win(), n=WINDOW_ROWS)


def rolling_sql(rows: str, order: str) -> str:
    """``rows`` has (team, won, ...): the wins up to each row less those up to the row
    WINDOW_ROWS before it, the most that any team has."""
    return f"""WITH {rows},
counted AS (
  SELECT team, row_number() OVER by_game AS nth, sum(won) OVER (by_game ROWS UNBOUNDED PRECEDING) AS so_far
  FROM played WINDOW by_game AS (PARTITION BY team ORDER BY {order})),
best AS (
  SELECT now.team, max(now.so_far - coalesce(past.so_far, 0)) AS wins
  FROM counted now LEFT JOIN counted past ON past.team IS NOT DISTINCT FROM now.team AND past.nth = now.nth - {WINDOW_ROWS}
  GROUP BY now.team)
SELECT team AS team_abbreviation, wins::BIGINT AS max_wins_in_90_game_stretch
FROM best ORDER BY wins DESC, team LIMIT 1"""


oracle("rolling_wins", rolling_sql(
    """played AS (SELECT team_abbreviation AS team, game_id, player_id, plus_minus,
                    coalesce(plus_minus::INT > 0, false)::INT AS won FROM fx_game_details)""",
    "game_id NULLS LAST, player_id NULLS LAST, plus_minus NULLS LAST"))


@query("longest_streak")
def longest_streak(spark, sf_dir):
    gd = fx.fx_game_details(spark, sf_dir)
    return sequences.longest_streak(gd, "player_name", ["game_id", "pts"], F.col("pts").cast("int") > 10)


# a run is what follows the same breaking row: the last one without enough points
STREAKS_SQL = """WITH lines AS (
  SELECT player_name, game_id, coalesce(CAST(pts AS INT) > 10, false) AS enough,
         row_number() OVER (PARTITION BY player_name ORDER BY game_id NULLS LAST, pts NULLS LAST) AS nth
  FROM fx_game_details),
runs AS (
  SELECT *, max(nth) FILTER (NOT enough) OVER (PARTITION BY player_name ORDER BY nth ROWS UNBOUNDED PRECEDING) AS broken_at
  FROM lines),
best AS (
  SELECT player_name, max(games)::BIGINT AS longest_streak_with_10_or_more_pts
  FROM (SELECT player_name, broken_at, count(game_id) AS games FROM runs WHERE enough GROUP BY ALL) r
  GROUP BY player_name)
"""
oracle("longest_streak", STREAKS_SQL + "SELECT * FROM best")


@query("longest_streak_top")
def longest_streak_top(spark, sf_dir):
    """The script's own form: the single longest streak."""
    gd = fx.fx_game_details(spark, sf_dir)
    return sequences.longest_streak(gd, "player_name", ["game_id", "pts"], F.col("pts").cast("int") > 10, top=1)


oracle("longest_streak_top", STREAKS_SQL + """SELECT * FROM best
ORDER BY longest_streak_with_10_or_more_pts DESC, player_name LIMIT 1""")


@query("page_transitions")
def page_transitions(spark, sf_dir):
    combined = cubes.web_events_combined(fx.fx_events(spark, sf_dir), fx.fx_devices(spark, sf_dir))
    return sequences.page_transitions(combined, min_users=MIN_HITS)


# for each visit, and each page of that user's day, the newest earlier visit there
oracle("page_transitions", f"""WITH visits AS (
  SELECT user_id, event_time::DATE AS day, event_time AS at, url FROM fx_events SEMI JOIN fx_devices USING (device_id)
  WHERE user_id IS NOT NULL AND event_time IS NOT NULL),
pages AS (SELECT DISTINCT user_id, day, url AS page FROM visits),
asked AS (SELECT v.*, p.page FROM visits v JOIN pages p USING (user_id, day)),
moves AS (
  SELECT a.user_id, a.url AS reached, a.page AS left_page, epoch_us(a.at) - epoch_us(f.at) AS took
  FROM asked a ASOF JOIN visits f ON f.user_id = a.user_id AND f.day = a.day AND f.url = a.page AND a.at > f.at),
fastest AS (SELECT user_id, reached, left_page, min(took) AS took FROM moves GROUP BY ALL)
SELECT reached AS to_url, left_page AS from_url, count(*) AS num_users, min(took) / 1e6 AS min_seconds,
       max(took) / 1e6 AS max_seconds, sum(took)::DOUBLE / count(*) / 1e6 AS avg_seconds
FROM fastest GROUP BY reached, left_page HAVING count(*) > {MIN_HITS}""")


@query("rolling_wins_fixed")
def rolling_wins_fixed(spark, sf_dir):
    """Over team games, not player lines: player lines are deduplicated, a
    team wins a game when its players' plus-minus sums above zero."""
    from snapfold.operators.facts import dedup
    lines = dedup(fx.fx_game_details(spark, sf_dir), ["game_id", "team_id", "player_id"])
    games = lines.groupBy("team_abbreviation", "game_id").agg(
        F.when(F.sum("plus_minus") > 0, 1).otherwise(0).alias("win"))
    return sequences.rolling_sum_top(games, "team_abbreviation", ["game_id"], F.col("win"), n=WINDOW_ROWS)


oracle("rolling_wins_fixed", rolling_sql(f"""line AS (
  SELECT DISTINCT ON (game_id, team_id, player_id) * FROM fx_game_details
  ORDER BY game_id, team_id, player_id, {_order_sql(["game_id", "team_id", "player_id"])}),
played AS (
  SELECT team_abbreviation AS team, game_id, (sum(plus_minus) > 0)::INT AS won
  FROM line GROUP BY team_abbreviation, game_id)""", "game_id NULLS LAST"))
