from __future__ import annotations

from pyspark.sql import functions as F

from snapfold.operators import cumulative as cu
from snapfold.operators import scd
from snapfold.plans.oracle import oracle
from snapfold.plans.registry import query
from snapfold.session import cut_lineage
from snapfold.sources import fixtures as fx

P_ATTRS = ["scoring_class", "is_active"]
A_ATTRS = ["quality_class", "is_active"]
P_NAMES = dict(start="start_season", end="end_season", current="current_season")
A_NAMES = dict(start="start_date", end="end_date", current="current_year")


def _players(spark, sf_dir):
    """The ``players`` table, stored once (the SCD jobs read it for the history,
    for the next period's snapshot and for the cutoff), and the cutoff: the
    backfill runs to the last-but-one season."""
    players = cut_lineage(cu.backfill_players(fx.fx_player_seasons(spark, sf_dir)))
    return players, players.select(F.max("current_season") - 1).scalar()


def _actors(spark, sf_dir):
    actors = cut_lineage(cu.backfill_actors(fx.fx_actor_films(spark, sf_dir)))
    return actors, actors.select(F.max("current_year") - 1).scalar()


def players_scd(spark, sf_dir, fixed=False):
    players, cutoff = _players(spark, sf_dir)
    return scd.scd2_backfill(players, "player_name", "current_season", P_ATTRS, cutoff, fixed=fixed, **P_NAMES)


def actors_scd(spark, sf_dir, fixed=False):
    actors, cutoff = _actors(spark, sf_dir)
    return scd.scd2_backfill(actors, "actor", "current_year", A_ATTRS, cutoff, fixed=fixed, **A_NAMES)


query("scd2_backfill_players")(lambda spark, sf_dir: players_scd(spark, sf_dir))
query("scd2_backfill_players_fixed")(lambda spark, sf_dir: players_scd(spark, sf_dir, fixed=True))
query("scd2_backfill_actors")(lambda spark, sf_dir: actors_scd(spark, sf_dir))
query("scd2_backfill_actors_fixed")(lambda spark, sf_dir: actors_scd(spark, sf_dir, fixed=True))


def _players_incremental(fixed):
    def run(spark, sf_dir):
        players, cutoff = _players(spark, sf_dir)
        hist = scd.scd2_backfill(players, "player_name", "current_season", P_ATTRS, cutoff, fixed=fixed,
                                 **P_NAMES)
        return scd.scd2_incremental(hist, players, "player_name", P_ATTRS, cutoff, emit_unchanged=fixed,
                                    null_safe=fixed, **P_NAMES)
    return run


def _actors_incremental(fixed):
    def run(spark, sf_dir):
        actors, cutoff = _actors(spark, sf_dir)
        hist = scd.scd2_backfill(actors, "actor", "current_year", A_ATTRS, cutoff, fixed=fixed, **A_NAMES)
        return scd.scd2_incremental(hist, actors, "actor", A_ATTRS, cutoff, emit_unchanged=True,
                                    closed_row_attrs="old" if fixed else "new", keep_current=True,
                                    null_safe=fixed, **A_NAMES)
    return run


query("scd2_incremental_players")(_players_incremental(False))
query("scd2_incremental_players_fixed")(_players_incremental(True))
query("scd2_incremental_actors")(_actors_incremental(False))
query("scd2_incremental_actors_fixed")(_actors_incremental(True))


@query("state_change")
def state_change(spark, sf_dir):
    return scd.state_change(players_scd(spark, sf_dir))


# --------------------------------------------------------------------------- oracle SQL
PLAYERS_SQL = """ps AS (SELECT * FROM fx_player_seasons),
b AS (SELECT max(season) AS hi FROM ps),
p AS (SELECT player_name, min(season) AS first_season FROM ps GROUP BY player_name),
grid AS (SELECT p.player_name, unnest(generate_series(p.first_season, b.hi)) AS current_season FROM p, b),
snap AS (SELECT g.player_name, CAST(g.current_season AS INTEGER) AS current_season,
                arg_max(ps.pts, ps.season) AS last_pts, max(ps.season) = g.current_season AS is_active
         FROM grid g JOIN ps ON ps.player_name = g.player_name AND ps.season <= g.current_season
         GROUP BY g.player_name, g.current_season),
entities AS (SELECT player_name, current_season,
                    CASE WHEN last_pts > 20 THEN 'star' WHEN last_pts > 15 THEN 'good'
                         WHEN last_pts > 10 THEN 'average' ELSE 'bad' END AS scoring_class,
                    is_active FROM snap),
cut AS (SELECT max(season) - 1 AS y FROM ps)"""

ACTORS_SQL = """af AS (SELECT * FROM fx_actor_films),
b AS (SELECT max(year) AS hi FROM af),
firsts AS (SELECT actor, min(year) AS f FROM af GROUP BY actor),
grid AS (SELECT actor, unnest(generate_series(f, b.hi)) AS year FROM firsts, b),
yr AS (SELECT actor, year, avg(CAST(rating AS DECIMAL(20,6))) AS avg_rating FROM af GROUP BY actor, year),
entities AS (SELECT g.actor, CAST(g.year AS INTEGER) AS current_year,
                    CASE WHEN avg_rating > 8 THEN 'star' WHEN avg_rating > 7 AND avg_rating <= 8 THEN 'good'
                         WHEN avg_rating > 6 AND avg_rating <= 7 THEN 'average' ELSE 'bad' END AS quality_class,
                    yr.actor IS NOT NULL AS is_active
             FROM grid g LEFT JOIN yr ON yr.actor = g.actor AND yr.year = g.year),
cut AS (SELECT max(year) - 1 AS y FROM af)"""


def backfill_sql(key, period, attrs, names, fixed):
    """Intervals from the yearly snapshots. An entity has one row a year from its
    first one on, so the years of an unbroken streak minus their rank among the
    entity's years with the same attributes are constant; without that term all
    years with the same attributes fall into one interval, as written."""
    same = ", ".join([key, *attrs])
    streak = f", {period} - row_number() OVER (PARTITION BY {same} ORDER BY {period}) AS streak" if fixed else ""
    return f"""years AS (SELECT {same}, {period} AS yr{streak} FROM entities WHERE {period} <= (SELECT y FROM cut)),
scd AS (SELECT {same}, min(yr) AS {names['start']}, max(yr) AS {names['end']}, (SELECT y FROM cut) AS {names['current']}
        FROM years GROUP BY {same}{', streak' if fixed else ''})"""


def incremental_sql(key, attrs, names, *, emit_unchanged, closed_new_attrs, keep_current, null_safe):
    """Each entity of the new period gets a verdict, each verdict its kinds of rows."""
    s, e, c = names["start"], names["end"], names["current"]
    differs = " OR ".join(f"n.{a} IS DISTINCT FROM o.{a}" if null_safe else f"n.{a} <> o.{a}" for a in attrs)
    equals = " AND ".join(f"n.{a} IS NOT DISTINCT FROM o.{a}" if null_safe else f"n.{a} = o.{a}" for a in attrs)
    emits = "('new', 'opened'), ('changed', 'closed'), ('changed', 'opened')" + (", ('same', 'kept')" if emit_unchanged else "")
    of = lambda a: f"CASE WHEN kind = 'closed' THEN {'new' if closed_new_attrs else 'old'}_{a} ELSE new_{a} END AS {a}"
    pairs = ", ".join(f"n.{a} AS new_{a}, o.{a} AS old_{a}" for a in attrs)
    last = f", {c}" if keep_current else ""
    return f"""WITH judged AS (
  SELECT n.{key}, {pairs}, o.{s} AS since, n.{c} AS now,
         CASE WHEN o.{key} IS NULL THEN 'new' WHEN {differs} THEN 'changed' WHEN {equals} THEN 'same' END AS verdict
  FROM (SELECT * FROM entities WHERE {c} = (SELECT y + 1 FROM cut)) n
  LEFT JOIN (SELECT * FROM scd WHERE {e} = (SELECT y FROM cut)) o USING ({key})),
emitted AS (
  SELECT {key}, {", ".join(of(a) for a in attrs)}, CASE WHEN kind = 'opened' THEN now ELSE since END AS {s},
         CASE WHEN kind = 'closed' THEN now - 1 ELSE now END AS {e},
         CASE WHEN kind = 'closed' THEN now - 1 ELSE now END AS {c}
  FROM judged JOIN (VALUES {emits}) rule(verdict, kind) USING (verdict))
SELECT {key}, {", ".join(attrs)}, {s}, {e}{last} FROM emitted
UNION ALL BY NAME
SELECT {key}, {", ".join(attrs)}, {s}, {e}{last} FROM scd WHERE {e} < (SELECT y FROM cut)"""


def _with(ctes: str, body: str) -> str:
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


for fixed in (False, True):
    sfx = "_fixed" if fixed else ""
    p_back = backfill_sql("player_name", "current_season", P_ATTRS, P_NAMES, fixed)
    a_back = backfill_sql("actor", "current_year", A_ATTRS, A_NAMES, fixed)
    oracle("scd2_backfill_players" + sfx, _with(f"{PLAYERS_SQL},\n{p_back}", "SELECT * FROM scd"))
    oracle("scd2_backfill_actors" + sfx, _with(f"{ACTORS_SQL},\n{a_back}", "SELECT * FROM scd"))
    oracle("scd2_incremental_players" + sfx, _with(
        f"{PLAYERS_SQL},\n{p_back}",
        incremental_sql("player_name", P_ATTRS, P_NAMES, emit_unchanged=fixed, closed_new_attrs=False,
                        keep_current=False, null_safe=fixed)))
    oracle("scd2_incremental_actors" + sfx, _with(
        f"{ACTORS_SQL},\n{a_back}",
        incremental_sql("actor", A_ATTRS, A_NAMES, emit_unchanged=True, closed_new_attrs=not fixed,
                        keep_current=True, null_safe=fixed)))

# the interval before each one by an as-of join; statuses from a lookup of both flags
oracle("state_change", _with(
    f"{PLAYERS_SQL},\n{backfill_sql('player_name', 'current_season', P_ATTRS, P_NAMES, False)}",
    f"""SELECT s.player_name, s.start_season,
       CASE WHEN p.player_name IS NULL AND s.is_active THEN '{scd.NEW}'
            ELSE coalesce(m.label, '{scd.UNKNOWN}') END AS player_status
FROM scd s ASOF LEFT JOIN scd p ON p.player_name = s.player_name AND p.start_season < s.start_season
LEFT JOIN (VALUES (true, true, '{scd.CONTINUED}'), (true, false, '{scd.RETURNED}'),
                  (false, true, '{scd.RETIRED}'), (false, false, '{scd.STAYED}')) m(is_now, was, label)
       ON m.is_now = s.is_active AND m.was = coalesce(p.is_active, false)"""))
