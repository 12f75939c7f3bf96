"""Multi-dimensional aggregation: GROUPING SETS / ROLLUP / CUBE dashboards and
the points report with ``GROUPING()`` and per-set ranks.

One Expand + one partial/final HashAggregate per dashboard: the low-cardinality
dimensions are combined map-side before the shuffle, so hot keys never reach a
single task as raw rows. The points report has a row per player, team and season, which
is too many to expand: see ``points_sets``. ``lattice`` serves several reports at once: the raw rows
are grouped once, to the finest cuboid, and every further set comes from a smaller
cuboid that is there already.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.functions.ordinals import rank_by_counts
from snapfold.functions.pgcompat import REFERRER_RULES, referrer_class
from snapfold.session import cut_lineage

OVERALL = "(overall)"
DASHBOARD_DIMS = ("referrer_mapped", "browser_type", "os_type")


def web_events_combined(events: DataFrame, devices: DataFrame, rules=REFERRER_RULES) -> DataFrame:
    """events JOIN devices with 'N/A' for missing device attributes and the
    referrer class. The planner picks broadcast or sort-merge from the size of
    ``devices``."""
    d = devices.select("device_id", "browser_type", "os_type")
    return (events.join(d, "device_id")
            .select(F.coalesce("browser_type", F.lit("N/A")).alias("browser_type"),
                    F.coalesce("os_type", F.lit("N/A")).alias("os_type"),
                    *[c for c in events.columns if c != "device_id"], "device_id",
                    referrer_class("referrer", rules).alias("referrer_mapped")))


# Counts of the dashboards, each a sum over any finer grouping: the url counted, None for all.
VISITS = {"number_of_site_hits": None, "number_of_signup_visits": "/signup", "number_of_contact_visits": "/contact",
          "number_of_login_visits": "/login"}


def _visits() -> list:
    return [F.count(F.lit(1) if url is None else F.when(F.col("url") == url, 1)).alias(name)
            for name, url in VISITS.items()]


def _signup_share():
    return (F.col("number_of_signup_visits").cast("double") / F.col("number_of_site_hits")).alias("pct_visited_signup")


# The sets of the grouping-sets dashboard.
DASHBOARD_SETS = (DASHBOARD_DIMS, ("os_type",), ("browser_type",), ("referrer_mapped",), ())


def web_dashboard(events: DataFrame, devices: DataFrame, mode: str = "sets",
                  min_hits: int | None = 100, rules=REFERRER_RULES) -> DataFrame:
    """Site hits and signup share by referrer class x browser x OS.

    mode: "sets" (the five sets), "rollup" or "cube". ``min_hits`` is the
    HAVING threshold (the cube report has none: pass None)."""
    combined = web_events_combined(events, devices, rules)
    cols = list(DASHBOARD_DIMS)
    if mode == "sets":
        grouped = combined.groupingSets([[F.col(c) for c in s] for s in DASHBOARD_SETS],
                                        *cols)
    elif mode == "rollup":
        grouped = combined.rollup(*cols)
    elif mode == "cube":
        grouped = combined.cube(*cols)
    else:
        raise ValueError(mode)
    out = grouped.agg(*_visits())
    if min_hits is not None:
        out = out.where(F.col("number_of_site_hits") > min_hits)
    return out.select(*_labelled(), *VISITS, _signup_share())


def _labelled() -> list:
    names = dict(zip(DASHBOARD_DIMS, ("referrer", "browser_type", "os_type")))
    return [F.coalesce(c, F.lit(OVERALL)).alias(name) for c, name in names.items()]


SET = "_set"        # bits of the dimensions that a cuboid has summed away, the first one highest


def set_number(dims: list[str], kept) -> int:
    return sum(1 << k for k, d in enumerate(reversed(dims)) if d not in kept)


def lattice(finest: DataFrame, dims: list[str], sets: list[tuple[str, ...]], sums: list[str]) -> DataFrame:
    """(dims, sums, SET) of every set in ``sets``: ``finest`` is a stored table with a row per
    combination of ``dims``, whose ``sums`` add up over any coarser grouping.

    Level by level, most dimensions first, a set is summed from the smallest cuboid that
    holds its dimensions, by rows counted: an Expand never sees more than that cuboid, and
    the raw rows not at all. Sets of one parent share an Expand. Each level is stored."""
    finest = finest.select(*dims, *sums).withColumn(SET, F.lit(0).cast("bigint"))
    built = {tuple(dims): (finest, finest.count())}
    out = [finest] if any(set(s) == set(dims) for s in sets) else []
    for size in range(len(dims) - 1, -1, -1):
        level = sorted({tuple(d for d in dims if d in s) for s in sets if len(set(s)) == size})
        children: dict[tuple[str, ...], list[tuple[str, ...]]] = {}
        for s in level:
            parent = min((p for p in built if set(s) < set(p)), key=lambda p: (built[p][1], p))
            children.setdefault(parent, []).append(s)
        made = None
        for parent, of in children.items():
            cols, df = list(parent), built[parent][0]
            total = [F.sum(m).cast(df.schema[m].dataType).alias(m) for m in sums]
            grouped = df.groupingSets([[F.col(c) for c in s] for s in of], *cols).agg(
                *total, *[F.grouping(c).alias(f"_{c}_gone") for c in cols])
            gone = [F.col(f"_{c}_gone").cast("bigint") if c in cols else F.lit(1).cast("bigint") for c in dims]
            number = sum((g * F.lit(1 << k) for k, g in enumerate(reversed(gone))), F.lit(0).cast("bigint"))
            part = grouped.select(*[F.col(c) if c in cols else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in dims],
                                  *sums, number.alias(SET))
            made = part if made is None else made.unionByName(part)
        if made is None:
            continue
        made = cut_lineage(made, "parquet")
        rows = {r[SET]: r["count"] for r in made.groupBy(SET).count().collect()}
        for s in level:
            n = set_number(dims, s)
            built[s] = (made.where(F.col(SET) == n), rows.get(n, 0))
        out.append(made)
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


ROLLUP_SETS = tuple(DASHBOARD_DIMS[:n] for n in range(len(DASHBOARD_DIMS), -1, -1))
CUBE_SETS = tuple(tuple(c) for n in range(len(DASHBOARD_DIMS), -1, -1) for c in combinations(DASHBOARD_DIMS, n))
# report: its sets, and whether its HAVING threshold applies
DASHBOARDS = {"grouping sets": (DASHBOARD_SETS, True), "rollup": (ROLLUP_SETS, True), "cube": (CUBE_SETS, False)}


def finest_visits(events: DataFrame, devices: DataFrame, rules=REFERRER_RULES) -> DataFrame:
    """The dashboards' finest cuboid, stored: the one pass over the events."""
    return cut_lineage(web_events_combined(events, devices, rules).groupBy(*DASHBOARD_DIMS).agg(*_visits()), "parquet")


def dashboards(finest: DataFrame, min_hits: int = 100) -> DataFrame:
    """All three dashboards, named in ``report``, from one stored finest cuboid."""
    dims = list(DASHBOARD_DIMS)
    every = lattice(finest, dims, sorted({s for sets, _ in DASHBOARDS.values() for s in sets}), list(VISITS))
    reports = [F.when(F.col(SET).isin([set_number(dims, s) for s in sets])
                      & ((F.col("number_of_site_hits") > min_hits) if having else F.lit(True)), F.lit(name))
               for name, (sets, having) in DASHBOARDS.items()]
    return every.withColumn("report", F.explode(F.array_compact(F.array(*reports)))).select(
        "report", *_labelled(), *VISITS, _signup_share())


def team_wins(lines: DataFrame) -> DataFrame:
    """Games and wins of each team and of all together: the sets (team) and () over one row
    per team and game, of which a team has won those where its players' plus-minus sums
    above zero. ``lines``: one row per player and game."""
    games = lines.groupBy("team_abbreviation", "game_id").agg(
        F.when(F.sum("plus_minus") > 0, 1).otherwise(0).alias("win"))
    return games.groupingSets([[F.col("team_abbreviation")], []], "team_abbreviation").agg(
        F.grouping("team_abbreviation").alias("is_team_agg"), F.count(F.lit(1)).alias("games_played"),
        F.sum("win").alias("games_won"))


def points_sets(details: DataFrame, player_seasons: DataFrame, fixed: bool = False) -> DataFrame:
    """Points over five grouping sets of (season, player, team) with a rank
    inside the row's own keys.

    As written the details are joined to the player's seasons on the name only,
    so every game counts once per season of the player. ``fixed`` joins on
    (name, season) with ``player_seasons`` carrying the game's own season, and
    ranks every set within its season.

    No Expand: the rows of players come from a window over one player's teams, and all
    other sets from ``counts``, the rows per season, team and total, which ranks are
    counted from as well."""
    keys = ["player_name", "season"] if fixed else ["player_name"]
    times = player_seasons.groupBy("player_name", "season").agg(F.count(F.lit(1)).alias("_times"))
    # SUM distributes over the join: sum the details per (join key, team)
    # first, so the join multiplies one row per player and team instead of
    # every game line by every season of the player.
    gd = (details.groupBy(*keys, "team_abbreviation")
                 .agg(F.sum(F.col("pts").cast("int")).alias("pts")))
    lines = _with_player_rows(gd.dropna(subset=keys), keys)
    if fixed:
        rows = cut_lineage(_in_seasons(lines, times, keys).drop("_rank"), "parquet")
    else:   # an inner join of two stored tables is read again, its many rows are not stored
        rows = _in_seasons(cut_lineage(lines, "parquet"), cut_lineage(times, "parquet"), keys)
    counts = cut_lineage(rows.groupBy("season", "team_abbreviation", "is_player_agg", "is_team_agg", "total_points")
                             .agg(F.count(F.lit(1)).alias("_n")), "parquet")
    teams = (counts.where("is_team_agg = 0").groupBy("season", "team_abbreviation")
                   .agg(F.sum(F.col("total_points") * F.col("_n")).alias("total_points"))
                   .withColumns({"is_player_agg": F.lit(1), "is_team_agg": F.lit(0)}))
    seasons = (teams.groupingSets([[F.col("season")], []], "season")
                    .agg(F.sum("total_points").alias("total_points"), F.grouping("season").alias("_all"))
                    .withColumns({"is_player_agg": F.lit(1), "is_team_agg": F.lit(1)}))
    if fixed:
        # one rank per set and season (the partition carries the grouping
        # flags): a whole season per set, so ranked by counting distinct totals
        of = ["season", "is_player_agg", "is_team_agg"]
        ranked = rank_by_counts(rows, of, "total_points", "_rank", counts=counts)
        teams = rank_by_counts(teams, of, "total_points", "_rank")
        seasons = seasons.withColumn("_rank", F.lit(1))
    else:
        # a player-team or player partition holds the few rows of one player; a
        # team's holds all its players, so its ranks are counted, for its totals alone
        ranked = rows
        teams = _team_ranks(teams, counts, seasons)
        seasons = seasons.withColumn("_rank", F.lit(None).cast("int"))
    names = ["season", "player_name", "team_abbreviation", "total_points", "_rank"]
    nobody = lambda df, *gone: df.withColumns({c: F.lit(None).cast("string") for c in gone}).select(*names)
    agg = (ranked.where("season IS NOT NULL").select(*names)
           .unionByName(nobody(teams.where("season IS NOT NULL OR team_abbreviation IS NULL"), "player_name"))
           .unionByName(nobody(seasons, "player_name", "team_abbreviation")))
    return agg.select("season", "player_name", "team_abbreviation",
                      F.col("total_points").cast("bigint").alias("total_points"),
                      F.when(F.col("season").isNotNull(), F.col("_rank")).cast("bigint").alias("rank_in_group"))


def _ahead(one: Column, other: Column) -> Column:
    """1 where ``one`` sorts before ``other``, descending with NULLs first."""
    return F.when(one.isNull(), other.isNotNull()).otherwise(F.coalesce(one > other, F.lit(False))).cast("int")


def _with_player_rows(gd: DataFrame, keys: list[str]) -> DataFrame:
    """``gd``, a row per ``keys`` and team, and a row per ``keys``: their points, the flags
    of both sets and the rank among the rows that share player and team, or for a row per
    ``keys`` among all rows of ``keys``. A player's seasons multiply all of them alike, so
    the ranks hold in each."""
    player = Window.partitionBy(*keys)
    own, whole, team = F.col("pts"), F.col("_whole"), "team_abbreviation"
    first = F.row_number().over(player.orderBy(F.col(team).asc_nulls_first()))
    with_whole = gd.withColumn("_whole", F.sum("pts").over(player)).withColumn("_first", first)
    with_place = with_whole.withColumn("_place", 1 + F.sum(_ahead(own, whole)).over(player))
    of_team = F.struct(F.col(team), own.alias("pts"), F.lit(0).alias("is_player_agg"), F.lit(0).alias("is_team_agg"),
                       F.when(F.col(team).isNull(), 1 + _ahead(whole, own)).otherwise(1).cast("bigint").alias("_rank"))
    of_player = F.struct(F.lit(None).cast("string").alias(team), whole.alias("pts"), F.lit(0).alias("is_player_agg"),
                         F.lit(1).alias("is_team_agg"), F.col("_place").cast("bigint").alias("_rank"))
    made = F.when(F.col("_first") == 1, F.array(of_team, of_player)).otherwise(F.array(of_team))
    return with_place.select(*keys, F.explode(made).alias("row")).select(*keys, "row.*")


def _in_seasons(lines: DataFrame, times: DataFrame, keys: list[str]) -> DataFrame:
    return lines.join(times, keys).select(
        "season", "player_name", "team_abbreviation", "is_player_agg", "is_team_agg",
        (F.col("pts") * F.col("_times")).alias("total_points"), "_rank")


def _team_ranks(teams: DataFrame, counts: DataFrame, seasons: DataFrame) -> DataFrame:
    """Rank of each team's row among all rows of its season and team, from the rows per total;
    where the team is NULL these include the rows of players and of the season."""
    t = teams.select("season", "team_abbreviation", F.col("total_points").alias("_of_team"))
    beside = counts.select("season", "team_abbreviation", "total_points", "_n").unionByName(
        seasons.where("_all = 0").select("season", F.lit(None).cast("string").alias("team_abbreviation"),
                                         "total_points", F.lit(1).cast("bigint").alias("_n")))
    same = (t.season.eqNullSafe(beside.season)) & t.team_abbreviation.eqNullSafe(beside.team_abbreviation)
    return (t.join(beside, same).groupBy(t.season, t.team_abbreviation)
             .agg(F.first("_of_team").alias("total_points"),
                  (1 + F.sum(F.col("_n") * _ahead(F.col("total_points"), F.col("_of_team")))).alias("_rank")))
