from __future__ import annotations

from pyspark.sql import functions as F

from snapfold.operators import cubes, facts
from snapfold.plans.oracle import REFERRER_CASE_SQL, oracle
from snapfold.plans.q_facts import _order_sql
from snapfold.plans.registry import query
from snapfold.sources import fixtures as fx

# HAVING threshold of the dashboards and the page-transition report.
MIN_HITS = 100


def _dashboard(mode, min_hits):
    def run(spark, sf_dir):
        out = cubes.web_dashboard(fx.fx_events(spark, sf_dir), fx.fx_devices(spark, sf_dir),
                                  mode=mode, min_hits=min_hits)
        return out.orderBy(F.desc_nulls_first("pct_visited_signup"), "referrer", "browser_type", "os_type")
    return run


query("dashboard_grouping_sets")(_dashboard("sets", MIN_HITS))
query("dashboard_rollup")(_dashboard("rollup", MIN_HITS))
query("dashboard_cube")(_dashboard("cube", None))

VISITS_SQL = f"""WITH visits AS (
  SELECT {REFERRER_CASE_SQL} AS source, coalesce(d.browser_type, 'N/A') AS browser, coalesce(d.os_type, 'N/A') AS os, url
  FROM fx_devices d JOIN fx_events e USING (device_id))
"""
R, B, O = "source", "browser", "os"  # noqa: E741


def dashboard_sql(sets, min_hits=None) -> str:
    """One aggregation per set, put together."""
    def one(dims):
        name = lambda d: d if d in dims else "'(overall)'"
        visits = lambda url: f"count(*) FILTER (url = '{url}')"
        return (f"SELECT {name(R)} AS referrer, {name(B)} AS browser_type, {name(O)} AS os_type, "
                f"count(*) AS number_of_site_hits, {visits('/signup')} AS number_of_signup_visits, "
                f"{visits('/contact')} AS number_of_contact_visits, {visits('/login')} AS number_of_login_visits, "
                f"{visits('/signup')} / count(*)::DOUBLE AS pct_visited_signup FROM visits"
                + (f" GROUP BY {', '.join(dims)}" if dims else "")
                + (f" HAVING count(*) > {min_hits}" if min_hits is not None else ""))
    return VISITS_SQL + "\nUNION ALL\n".join(map(one, sets))


oracle("dashboard_grouping_sets", dashboard_sql([(R, B, O), (O,), (B,), (R,), ()], MIN_HITS))
oracle("dashboard_rollup", dashboard_sql([(R, B, O), (R, B), (R,), ()], MIN_HITS))
oracle("dashboard_cube", dashboard_sql([(R, B, O), (R, B), (R, O), (B, O), (R,), (B,), (O,), ()]))


@query("dashboard_lattice")
def dashboard_lattice(spark, sf_dir):
    """The three dashboards at once, from one finest cuboid."""
    return cubes.dashboards(cubes.finest_visits(fx.fx_events(spark, sf_dir), fx.fx_devices(spark, sf_dir)), MIN_HITS)


_REPORTS = {"grouping sets": ([(R, B, O), (O,), (B,), (R,), ()], MIN_HITS), "rollup": ([(R, B, O), (R, B), (R,), ()], MIN_HITS),
            "cube": ([(R, B, O), (R, B), (R, O), (B, O), (R,), (B,), (O,), ()], None)}
oracle("dashboard_lattice", VISITS_SQL + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS report, * FROM ({dashboard_sql(*of).removeprefix(VISITS_SQL)}) r" for name, of in _REPORTS.items()))


def _team_wins(spark, sf_dir):
    lines = facts.dedup(fx.fx_game_details(spark, sf_dir), ["game_id", "team_id", "player_id"])
    return cubes.team_wins(lines)


@query("team_wins")
def team_wins(spark, sf_dir):
    """The grouping-sets report's third question: games and wins by team and in all."""
    return _team_wins(spark, sf_dir).orderBy(F.desc("games_won"), F.asc_nulls_last("team_abbreviation"))


@query("team_most_wins")
def team_most_wins(spark, sf_dir):
    """Which team has won the most games (ties: the first by name)."""
    return _team_wins(spark, sf_dir).where("is_team_agg = 0").select("team_abbreviation", "games_won") \
        .orderBy(F.desc("games_won"), F.asc_nulls_last("team_abbreviation")).limit(1)


TEAM_WINS_SQL = f"""WITH line AS (
  SELECT DISTINCT ON (game_id, team_id, player_id) * FROM fx_game_details
  ORDER BY game_id, team_id, player_id, {_order_sql(["game_id", "team_id", "player_id"])}),
game AS (SELECT team_abbreviation AS team, (sum(plus_minus) > 0)::INT AS won FROM line GROUP BY team_abbreviation, game_id)
"""
oracle("team_wins", TEAM_WINS_SQL + """SELECT team AS team_abbreviation, 0 AS is_team_agg, count(*) AS games_played,
       sum(won)::BIGINT AS games_won FROM game GROUP BY team
UNION ALL SELECT NULL, 1, count(*), sum(won)::BIGINT FROM game""")
oracle("team_most_wins", TEAM_WINS_SQL + """SELECT team AS team_abbreviation, sum(won)::BIGINT AS games_won FROM game
GROUP BY team ORDER BY games_won DESC, team NULLS LAST LIMIT 1""")


def in_order(points):
    return points.orderBy(F.asc_nulls_last("season"), F.desc_nulls_first("total_points"),
                          F.asc_nulls_last("player_name"), F.asc_nulls_last("team_abbreviation"))


@query("points_grouping_sets")
def points_grouping_sets(spark, sf_dir):
    return in_order(cubes.points_sets(fx.fx_game_details(spark, sf_dir), fx.fx_detail_player_seasons(spark, sf_dir)))


@query("points_grouping_sets_fixed")
def points_grouping_sets_fixed(spark, sf_dir):
    gd = fx.fx_game_details(spark, sf_dir)
    g = fx.fx_games(spark, sf_dir).select("game_id", "season")
    return in_order(cubes.points_sets(gd.join(g, "game_id"), fx.fx_detail_player_seasons(spark, sf_dir), fixed=True))


def points_sql(lines: str, partition: dict[str, list[str]]) -> str:
    """One aggregation per set; a rank counts the rows of the partition that sort
    before the row. ``partition``: the rank's columns for each kind of row."""
    kinds = {"player-team": ("season", "player", "team"), "player": ("season", "player"),
             "team": ("season", "team"), "season": ("season",), "all": ()}
    of = lambda d, dims: d if d in dims else f"NULL AS {d}"
    sets = "\n  UNION ALL ".join(
        f"SELECT '{kind}' AS kind, {', '.join(of(d, dims) for d in ('season', 'player', 'team'))}, sum(pts) AS points "
        f"FROM lines{' GROUP BY ' + ', '.join(dims) if dims else ''}" for kind, dims in kinds.items())
    ranked = "\nUNION ALL ".join(
        f"SELECT x.season, x.player, x.team, x.points, 1 + coalesce((SELECT sum(rows_) FROM (SELECT points AS p, count(*) AS rows_ "
        f"FROM totals y WHERE {' AND '.join(f'y.{c} IS NOT DISTINCT FROM x.{c}' for c in cols)} GROUP BY points) b "
        f"WHERE b.p > x.points OR (b.p IS NULL AND x.points IS NOT NULL)), 0) AS place FROM totals x "
        f"WHERE x.kind = '{kind}' AND x.season IS NOT NULL" for kind, cols in partition.items())
    rest = " AND ".join(f"kind <> '{k}'" for k in partition) or "true"
    return f"""WITH lines AS ({lines}),
every AS ({sets}),
totals AS (SELECT * FROM every WHERE season IS NOT NULL OR (player IS NULL AND team IS NULL)),
ranked AS ({ranked}
UNION ALL SELECT season, player, team, points, NULL FROM totals WHERE season IS NULL OR ({rest}))
SELECT season, player AS player_name, team AS team_abbreviation, points::BIGINT AS total_points,
       place::BIGINT AS rank_in_group FROM ranked"""


oracle("points_grouping_sets", points_sql(
    """SELECT ps.season, player_name AS player, team_abbreviation AS team, CAST(pts AS INT) AS pts
  FROM fx_detail_player_seasons ps JOIN fx_game_details USING (player_name)""",
    {"player-team": ["season", "player", "team"], "player": ["season", "player"], "team": ["season", "team"]}))

oracle("points_grouping_sets_fixed", points_sql(
    """SELECT season, player_name AS player, team_abbreviation AS team, CAST(pts AS INT) AS pts
  FROM fx_game_details JOIN (SELECT game_id, season FROM fx_games) g USING (game_id)
       SEMI JOIN fx_detail_player_seasons USING (player_name, season)""",
    {k: ["season", "kind"] for k in ("player-team", "player", "team", "season")}))
