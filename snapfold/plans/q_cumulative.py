from __future__ import annotations

from pyspark.sql import functions as F

from snapfold.operators import cumulative as cu
from snapfold.plans.oracle import oracle
from snapfold.plans.registry import query
from snapfold.sources import fixtures as fx


def bounds(df, col):
    """(min, max) of a period column: two scalars for the driver loop."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return int(r["lo"]), int(r["hi"])


def players_table(spark, sf_dir):
    """The cumulative ``players`` table (every snapshot) in one pass."""
    return cu.backfill_players(fx.fx_player_seasons(spark, sf_dir))


def players_latest(spark, sf_dir):
    """The snapshot of the last season (the last snapshot = the last season
    of player_seasons, so the scalar does not rebuild the table)."""
    seasons = fx.fx_player_seasons(spark, sf_dir)
    p = cu.backfill_players(seasons)
    return p.where(F.col("current_season") == seasons.select(F.max("season")).scalar())


def _explode_players(df):
    keys = ["player_name", *cu.PLAYER_STATIC, "scoring_class", "years_since_last_season",
            "current_season", "is_active"]
    return cu.explode_history(df, keys=keys, with_pos=True)


def _players_step(fixed):
    def run(spark, sf_dir):
        seasons = fx.fx_player_seasons(spark, sf_dir)
        lo, hi = bounds(seasons, "season")
        return _explode_players(cu.fold_players(seasons, lo, hi, fixed=fixed, at_once=cu.AT_ONCE))
    return run


query("players_step")(_players_step(False))
query("players_step_fixed")(_players_step(True))


@query("players_backfill")
def players_backfill(spark, sf_dir):
    return _explode_players(players_table(spark, sf_dir))


def players_closed_form(is_active_sql: str) -> str:
    static = ", ".join(f"max({c}) AS {c}" for c in cu.PLAYER_STATIC)
    static_g = ", ".join(f"g.{c}" for c in cu.PLAYER_STATIC)
    static_o = ", ".join(cu.PLAYER_STATIC)
    return f"""WITH ps AS (SELECT * FROM fx_player_seasons),
b AS (SELECT max(season) AS hi FROM ps),
p AS (SELECT player_name, min(season) AS first_season, {static} FROM ps GROUP BY player_name),
grid AS (SELECT p.*, unnest(generate_series(p.first_season, b.hi)) AS current_season FROM p, b),
hist AS (
  SELECT g.player_name, {static_g}, g.current_season,
         ps.season, ps.gp, ps.pts, ps.reb, ps.ast,
         row_number() OVER (PARTITION BY g.player_name, g.current_season ORDER BY ps.season) - 1 AS pos,
         last_value(ps.pts) OVER (PARTITION BY g.player_name, g.current_season ORDER BY ps.season
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_pts,
         max(ps.season) OVER (PARTITION BY g.player_name, g.current_season) AS last_season
  FROM grid g JOIN ps ON ps.player_name = g.player_name AND ps.season <= g.current_season)
SELECT player_name, {static_o},
       CASE WHEN last_pts > 20 THEN 'star' WHEN last_pts > 15 THEN 'good'
            WHEN last_pts > 10 THEN 'average' ELSE 'bad' END AS scoring_class,
       current_season - last_season AS years_since_last_season, current_season,
       {is_active_sql} AS is_active, pos, season, gp, pts, reb, ast
FROM hist"""


oracle("players_step", players_closed_form("CAST(NULL AS BOOLEAN)"))
oracle("players_step_fixed", players_closed_form("last_season = current_season"))
oracle("players_backfill", players_closed_form("last_season = current_season"))


@query("players_first_last")
def players_first_last(spark, sf_dir):
    return cu.first_last(players_latest(spark, sf_dir))


oracle("players_first_last", """SELECT player_name, min(season) AS first_season, arg_min(pts, season) AS first_pts,
       max(season) AS latest_season, arg_max(pts, season) AS latest_pts
FROM fx_player_seasons GROUP BY player_name""")


@query("players_improvement")
def players_improvement(spark, sf_dir):
    return cu.improvement_ratio(players_latest(spark, sf_dir))


oracle("players_improvement", """SELECT player_name, latest / CASE WHEN first = 0 THEN 1 ELSE first END AS avg_pts
FROM (SELECT player_name, arg_min(pts, season) AS first, arg_max(pts, season) AS latest
      FROM fx_player_seasons GROUP BY player_name) t
WHERE latest > 20""")


@query("players_unnest")
def players_unnest(spark, sf_dir):
    return cu.explode_history(players_latest(spark, sf_dir))


oracle("players_unnest", "SELECT player_name, season, gp, pts, reb, ast FROM fx_player_seasons")


@query("players_versions")
def players_versions(spark, sf_dir):
    return players_table(spark, sf_dir).groupBy("player_name").agg(F.count(F.lit(1)).alias("num_versions"))


oracle("players_versions", """SELECT player_name,
       CAST((SELECT max(season) FROM fx_player_seasons) - min(season) + 1 AS BIGINT) AS num_versions
FROM fx_player_seasons GROUP BY player_name""")


# --------------------------------------------------------------------------- actors
def actors_table(spark, sf_dir):
    return cu.backfill_actors(fx.fx_actor_films(spark, sf_dir))


def _explode_actors(df):
    keys = ["actor", "year", "quality_class", "current_year", "is_active"]
    return cu.explode_history(df, arr="films", keys=keys, with_pos=True)


def _actors_step(carry):
    def run(spark, sf_dir):
        films = fx.fx_actor_films(spark, sf_dir)
        lo, hi = bounds(films, "year")
        return _explode_actors(cu.fold_actors(films, lo, hi, carry_class=carry, at_once=cu.AT_ONCE))
    return run


query("actors_step")(_actors_step(False))
query("actors_step_fixed")(_actors_step(True))


@query("actors_backfill")
def actors_backfill(spark, sf_dir):
    return _explode_actors(actors_table(spark, sf_dir))


ACTORS_CLOSED_FORM = """WITH af AS (SELECT * FROM fx_actor_films),
b AS (SELECT max(year) AS hi FROM af),
firsts AS (SELECT actor, min(year) AS f FROM af GROUP BY actor),
grid AS (SELECT actor, unnest(generate_series(f, b.hi)) AS year FROM firsts, b),
yr AS (SELECT actor, year, avg(CAST(rating AS DECIMAL(20,6))) AS avg_rating FROM af GROUP BY actor, year),
g2 AS (SELECT g.actor, g.year, yr.avg_rating, yr.actor IS NOT NULL AS is_active
       FROM grid g LEFT JOIN yr ON yr.actor = g.actor AND yr.year = g.year)
SELECT g2.actor, CAST(g2.year AS INTEGER) AS year,
       CASE WHEN avg_rating > 8 THEN 'star' WHEN avg_rating > 7 AND avg_rating <= 8 THEN 'good'
            WHEN avg_rating > 6 AND avg_rating <= 7 THEN 'average' ELSE 'bad' END AS quality_class,
       CAST(g2.year AS INTEGER) AS current_year, g2.is_active,
       row_number() OVER (PARTITION BY g2.actor, g2.year ORDER BY af.year, af.film) - 1 AS pos,
       af.film, af.votes, af.rating, af.filmid
FROM g2 JOIN af ON af.actor = g2.actor AND af.year <= g2.year"""

oracle("actors_step", ACTORS_CLOSED_FORM)
oracle("actors_backfill", ACTORS_CLOSED_FORM)

# D2 fixed: an inactive year keeps the class of the last active year
oracle("actors_step_fixed", ACTORS_CLOSED_FORM.replace(
    """g2 AS (SELECT g.actor, g.year, yr.avg_rating, yr.actor IS NOT NULL AS is_active
       FROM grid g LEFT JOIN yr ON yr.actor = g.actor AND yr.year = g.year)""",
    """g2 AS (SELECT g.actor, g.year, arg_max(yr.avg_rating, yr.year) AS avg_rating,
              bool_or(yr.year = g.year) AS is_active
       FROM grid g JOIN yr ON yr.actor = g.actor AND yr.year <= g.year
       GROUP BY g.actor, g.year)"""))
