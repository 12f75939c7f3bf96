"""Cumulative snapshot tables with array-of-struct history.

Two ways to build the same table:

* ``cumulate_*(prev, today)`` - one period: full outer join of yesterday's
  snapshot with today's rows (the incremental job that runs once a period);
  ``fold_changes`` runs it over a range of periods and writes, for each, the
  entities that the period saw and no others; a catch-up takes several periods
  in a job. ``fold_periods`` writes whole snapshots.
* ``backfill_*`` - every period in one pass: one aggregation per entity to a
  sorted history array, then ``explode(sequence(first, last))`` and a
  ``filter`` of the history - no theta join and no O(n^2) running window.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StructField, StructType

from snapfold.functions.pgcompat import first_elem, last_elem, safe_divisor, score_class
from snapfold.session import scratch_path, stage_by_period

PLAYER_STATIC = ("height", "college", "country", "draft_year", "draft_round", "draft_number")
STAT_FIELDS = ("season", "gp", "pts", "reb", "ast")
FILM_FIELDS = ("film", "votes", "rating", "filmid")

PLAYER_COLUMNS = ("player_name", *PLAYER_STATIC, "season_stats", "scoring_class",
                  "years_since_last_season", "current_season", "is_active")
FOLD_STEP = "fold_step"  # partition column of a fold's table
ACTOR_COLUMNS = ("actor", "year", "films", "quality_class", "current_year", "is_active")


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def fold_periods(initial: DataFrame, periods: Iterable, step: Callable[[DataFrame, object], DataFrame],
                 keep_all: bool = True) -> DataFrame:
    """Run ``step(state, period)`` over ``periods``. Every new state is written
    as one partition of a Parquet table in the shared folder, so step N reads
    step N-1 from files (columns pruned) instead of recomputing it, and a lost
    executor only re-reads one step. Returns all snapshots - one scan of that
    table, however many periods - or the last one."""
    spark = initial.sparkSession
    base = scratch_path(spark, "fold")
    state, n = initial, 0
    for n, p in enumerate(periods, start=1):
        out = step(state, p)
        schema = out.schema
        out.hint("rebalance").write.parquet(f"{base}/{FOLD_STEP}={n}")
        state = spark.read.schema(schema).parquet(f"{base}/{FOLD_STEP}={n}")
    if not n or not keep_all:
        return state
    return spark.read.schema(state.schema).parquet(base).select(*state.columns)


PERIOD = "_period"      # number of the period, from 1, in which a row of a history was written
BASE_EVERY = 8          # periods between two bases of a history
AT_ONCE = 16            # periods that a job of a catch-up takes
Field = Callable[[str], Column]                         # a row's field by name
# a row, and the period it is to be brought to -> the fields that time alone changes
Aged = Callable[[Field, Column], dict[str, Column]]
# today's row and the state of the period before (null for a new entity) -> the new state
Row = Callable[[Field, Field], list[Column]]


def prefixed(prefix: str) -> Field:
    return lambda c: F.col(prefix + c)


def fold_changes(initial: DataFrame, periods: Iterable, key: str, at: str, today: Callable[..., DataFrame],
                 row: Row | list[Column], aged: Aged, base_every: int = BASE_EVERY, at_once: int = 1) -> DataFrame:
    """All snapshots of a cumulative table, folded period by period from a history that
    holds changes only.

    ``today(p)`` has the rows of one period, one per entity, with p in column ``at`` (taken
    from there, so that all steps run the same generated code). A period writes the entities
    that it saw, whatever the table holds besides: their state before (the newest of the
    last base and the changes since) and their row of today meet in one aggregation by
    key, and ``row`` is the new state in terms of today's columns and the state as of the
    period before, given as fields or, as a list, as columns ``t_*`` and ``y_*``. Every
    ``base_every`` periods the newest row of each entity is written as a base, which bounds
    what a step reads.
    ``at_once``: the periods that one job takes, for a catch-up. ``today(p, q)`` then has the
    rows of p to q, and the same aggregation by key gathers an entity's rows of these
    periods - at most ``at_once`` of them - which its state runs through one after the other;
    the rows written are the same as with one period a job.
    A snapshot is derived when it is read: an entity's newest row, with the fields that
    ``aged`` names brought to the snapshot's period. Periods are consecutive integers or
    days. Everything lies in the shared folder, so a lost executor re-reads one step."""
    spark, periods = initial.sparkSession, list(periods)
    if not periods:
        return initial
    if at_once > 1 and not callable(row):
        raise ValueError("several periods at once need a row in terms of fields")
    root, columns = scratch_path(spark, "history"), initial.columns
    first, days = F.lit(periods[0]), isinstance(periods[0], dt.date)
    # read from files: any field or element may be null
    stored = StructType([*DataType.fromDDL(initial.schema.simpleString()).fields, StructField(PERIOD, IntegerType())])

    def brought(c: Field, to: Column) -> list[Column]:
        new = aged(c, to)
        return [new.get(name, c(name)) for name in columns]

    def as_before(y: Column, now: Column) -> list[Column]:
        before = F.date_sub(now, 1) if days else (now - 1).cast("int")
        return [F.when(y.isNotNull(), x) for x in brought(lambda c: y[c], before)]

    def number(now: Column) -> Column:
        return ((F.datediff(now, first) if days else now - first) + 1).cast("int").alias(PERIOD)

    # the step's expressions, made once: they name columns, not tables
    given = today(periods[0]).columns
    seen = [F.col(key).cast(stored[key].dataType).alias(key), F.struct(*given).alias("t")]
    past = [F.col(key), F.struct(*columns, PERIOD).alias("y")]
    newest_of = F.max_by("y", F.col("y")[PERIOD]).alias("y")
    now = F.col("t")[at]
    joined = [*[F.col("t")[c].alias("t_" + c) for c in given],
              *[x.alias("y_" + c) for c, x in zip(columns, as_before(F.col("y"), now))], number(now)]
    one = [*(row(prefixed("t_"), prefixed("y_")) if callable(row) else row), F.col(PERIOD)]

    def after(states: Column, e: Column) -> Column:
        """The states so far and the one that follows from the last of them."""
        t, then = e["t"], e["at"]
        y = dict(zip(columns, as_before(F.element_at(states, -1), then)))
        new = [x.cast(stored[c].dataType).alias(c) for c, x in zip(columns, row(lambda c: t[c], y.__getitem__))]
        return F.concat(states, F.array(F.struct(*new, number(then))))

    in_order = F.array_sort(F.collect_list(F.when(F.col("t").isNotNull(), F.struct(now.alias("at"), "t")))).alias("ts")
    newest: list[str] = []                          # the last base, and the changes since
    based = 0                                       # the period of the last base
    for n in range(0, len(periods), at_once):
        block = periods[n:n + at_once]
        n += len(block)
        rows = today(block[0]) if len(block) == 1 else today(block[0], block[-1])
        rows = rows.select(*seen)
        if newest:
            old = spark.read.schema(stored).parquet(*newest).select(*past)
            rows = rows.unionByName(old, allowMissingColumns=True)
        else:
            rows = rows.withColumn("y", F.lit(None).cast(stored))
        if len(block) > 1:
            states = F.aggregate("ts", F.array(F.col("y").cast(stored)), after)
            rows = rows.groupBy(key).agg(in_order, newest_of).where(F.size("ts") > 0)
            rows = rows.select(F.inline(F.slice(states, F.lit(2), F.size("ts"))))
        else:
            if newest:
                rows = rows.groupBy(key).agg(F.any_value("t", True).alias("t"), newest_of).where("t IS NOT NULL")
            rows = rows.select(*joined).select(*one)
        path = f"{root}/changes/{n}"
        rows.write.parquet(path)
        newest.append(path)
        if n - based >= base_every and n < len(periods):
            base, based = f"{root}/base/{n}", n
            spark.read.schema(stored).parquet(*newest).select(*past).groupBy(key).agg(newest_of).select("y.*").write.parquet(base)
            newest = [base]
    changes = spark.read.schema(stored).option("recursiveFileLookup", "true").parquet(f"{root}/changes")
    until = F.lead(PERIOD).over(Window.partitionBy(key).orderBy(PERIOD)) - 1
    each = changes.withColumn("_until", F.coalesce(until, F.lit(len(periods)))) \
        .withColumn("_at", F.explode(F.sequence(PERIOD, "_until")))
    to = F.date_add(first, F.col("_at") - 1) if days else (first + F.col("_at") - 1).cast("int")
    return each.select(*[x.alias(c) for c, x in zip(columns, brought(F.col, to))])


# --------------------------------------------------------------------------- players
def player_stats_struct(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + f).alias(f) for f in STAT_FIELDS])


def cumulate_players(prev: DataFrame, today: DataFrame, fixed: bool = False) -> DataFrame:
    """One season of the cumulative ``players`` table.

    ``prev`` is the snapshot of the previous season, ``today`` the season's
    rows of player_seasons. As written the insert lists 11 of the 12 columns,
    so ``is_active`` is NULL; ``fixed`` fills it with "played this season"."""
    t = _prefixed(today, "t_")
    y = _prefixed(prev.select(*PLAYER_COLUMNS), "y_")
    return t.join(y, F.col("t_player_name") == F.col("y_player_name"), "full_outer") \
        .select(*_players_row(fixed)(prefixed("t_"), prefixed("y_")))


def _players_row(fixed: bool) -> Row:
    """The new state from today's row and the snapshot of the season before."""
    def row(t, y):
        played = t("season").isNotNull()
        stat = F.array(F.struct(*[t(f).alias(f) for f in STAT_FIELDS]))
        return [
            F.coalesce(t("player_name"), y("player_name")).alias("player_name"),
            *[F.coalesce(t(c), y(c)).alias(c) for c in PLAYER_STATIC],
            F.when(y("season_stats").isNull(), stat)
             .when(played, F.concat(y("season_stats"), stat))
             .otherwise(y("season_stats")).alias("season_stats"),
            F.when(played, score_class(t("pts"))).otherwise(y("scoring_class")).alias("scoring_class"),
            F.when(played, F.lit(0)).otherwise(y("years_since_last_season") + 1)
             .cast("int").alias("years_since_last_season"),
            F.coalesce(t("season"), y("current_season") + 1).cast("int").alias("current_season"),
            (played if fixed else F.lit(None).cast("boolean")).alias("is_active")]
    return row


def _empty_players(seasons: DataFrame) -> DataFrame:
    s = seasons.limit(0)
    return s.select(
        "player_name", *PLAYER_STATIC,
        F.array(player_stats_struct()).alias("season_stats"),
        F.lit(None).cast("string").alias("scoring_class"),
        F.lit(None).cast("int").alias("years_since_last_season"),
        F.lit(None).cast("int").alias("current_season"),
        F.lit(None).cast("boolean").alias("is_active"))


def _players_aged(fixed: bool) -> Aged:
    """Seasons that a player sits out."""
    def aged(c, at):
        missed = at - c("current_season")
        return {"years_since_last_season": (c("years_since_last_season") + missed).cast("int"), "current_season": at,
                "is_active": F.when(missed == 0, c("is_active")).otherwise(F.lit(False if fixed else None).cast("boolean"))}
    return aged


def fold_players(seasons: DataFrame, first: int, last: int, fixed: bool = False, at_once: int = 1) -> DataFrame:
    """All snapshots first..last built season by season; a season writes its own players."""
    src = stage_by_period(seasons, "season")  # built once; each step reads its partitions
    return fold_changes(_empty_players(src), range(first, last + 1), "player_name", "season",
                        lambda s, to=None: src.where(F.col("season").between(s, s if to is None else to)),
                        _players_row(fixed), _players_aged(fixed), at_once=at_once)


def backfill_players(seasons: DataFrame, lo: Column | int | None = None,
                     hi: Column | int | None = None) -> DataFrame:
    """Every player x season lo..hi snapshot in one pass: stats list of seasons
    up to the snapshot, static attributes by MAX, class from the last struct,
    ``is_active`` = the last struct is this season."""
    lo = F.lit(lo) if isinstance(lo, int) else lo
    hi = F.lit(hi) if isinstance(hi, int) else hi
    if hi is None:
        hi = seasons.select(F.max("season")).scalar()
    per_player = seasons.groupBy("player_name").agg(
        F.min("season").alias("first_season"),
        F.array_sort(F.collect_list(player_stats_struct())).alias("all_stats"),
        *[F.max(c).alias(c) for c in PLAYER_STATIC])
    start = F.col("first_season") if lo is None else F.greatest(F.col("first_season"), lo)
    grid = per_player.select("*", F.explode(F.sequence(start, hi)).alias("current_season"))
    lower = (lambda x: F.lit(True)) if lo is None else (lambda x: x["season"] >= lo)
    hist = grid.withColumn("season_stats", F.filter(
        "all_stats", lambda x: lower(x) & (x["season"] <= F.col("current_season"))))
    last = last_elem("season_stats")
    return hist.select(
        "player_name", *PLAYER_STATIC, "season_stats",
        score_class(last["pts"]).alias("scoring_class"),
        (F.col("current_season") - last["season"]).cast("int").alias("years_since_last_season"),
        F.col("current_season").cast("int").alias("current_season"),
        (last["season"] == F.col("current_season")).alias("is_active"))


def first_last(players: DataFrame, arr: str = "season_stats") -> DataFrame:
    """First and latest history element and their points."""
    first, last = first_elem(arr), last_elem(arr)
    return players.select("player_name",
                          first["season"].alias("first_season"), first["pts"].alias("first_pts"),
                          last["season"].alias("latest_season"), last["pts"].alias("latest_pts"))


def improvement_ratio(players: DataFrame, cls: str = "star") -> DataFrame:
    """Latest points over first points (0 -> 1) for one scoring class."""
    first, last = first_elem("season_stats"), last_elem("season_stats")
    return (players.where(F.col("scoring_class") == cls)
                   .select("player_name", (last["pts"] / safe_divisor(first["pts"])).alias("avg_pts")))


def explode_history(players: DataFrame, arr: str = "season_stats", keys=("player_name",),
                    with_pos: bool = False) -> DataFrame:
    """Array of struct -> one row per element with the struct's fields as
    columns (``inline``); ``with_pos`` keeps the 0-based position."""
    if with_pos:
        return players.select(*keys, F.posexplode(arr).alias("pos", "_el")).select(*keys, "pos", "_el.*")
    return players.select(*keys, F.inline(arr))


# --------------------------------------------------------------------------- actors
def film_struct() -> Column:
    return F.struct(*[F.col(f) for f in FILM_FIELDS])


def exact_avg(c: str) -> Column:
    """AVG in decimal: a float sum depends on the order rows arrive in, which
    would let a class threshold flip between runs and partitionings."""
    return F.avg(F.col(c).cast("decimal(20,6)"))


def quality_class(avg: Column) -> Column:
    """As written: > 8 star, (7, 8] good, (6, 7] average, else (also NULL) bad."""
    return (F.when(avg > 8, "star").when((avg > 7) & (avg <= 8), "good")
             .when((avg > 6) & (avg <= 7), "average").otherwise("bad"))


def cumulate_actors(prev: DataFrame, films: DataFrame, carry_class: bool = False) -> DataFrame:
    """One year of the cumulative ``actors`` table: append the year's films
    (sorted by title), class from the year's average rating, active flag.

    As written an actor without films this year gets class 'bad' (the average
    is NULL); ``carry_class`` keeps the previous class instead."""
    n = _prefixed(_films_of_year(films), "t_")
    y = _prefixed(prev.select(*ACTOR_COLUMNS), "y_")
    return n.join(y, F.col("t_actor") == F.col("y_actor"), "full_outer") \
        .select(*_actors_row(carry_class)(prefixed("t_"), prefixed("y_")))


def _films_of_year(films: DataFrame) -> DataFrame:
    return films.groupBy("actor", "year").agg(
        F.array_sort(F.collect_list(film_struct())).alias("new_films"),
        exact_avg("rating").alias("avg_rating"))


def _actors_row(carry_class: bool) -> Row:
    """The new state from the year's films and the snapshot of the year before."""
    def row(t, y):
        year = F.coalesce(t("year"), y("year") + 1).cast("int")
        rated = quality_class(t("avg_rating"))
        return [
            F.coalesce(t("actor"), y("actor")).alias("actor"),
            year.alias("year"),
            F.when(y("films").isNull(), t("new_films"))
             .when(t("new_films").isNull(), y("films"))
             .otherwise(F.concat(y("films"), t("new_films"))).alias("films"),
            (F.when(t("avg_rating").isNotNull(), rated).otherwise(y("quality_class")) if carry_class
             else rated).alias("quality_class"),
            year.alias("current_year"),
            t("new_films").isNotNull().alias("is_active")]
    return row


def _empty_actors(films: DataFrame) -> DataFrame:
    return films.limit(0).select(
        "actor", F.col("year").cast("int").alias("year"), F.array(film_struct()).alias("films"),
        F.lit(None).cast("string").alias("quality_class"), F.lit(None).cast("int").alias("current_year"),
        F.lit(None).cast("boolean").alias("is_active"))


def _actors_aged(carry_class: bool) -> Aged:
    """Years without a film of the actor."""
    def aged(c, at):
        idle = at > c("current_year")
        none = c("quality_class") if carry_class else quality_class(F.lit(None).cast("double"))
        return {"year": at, "current_year": at, "is_active": c("is_active") & ~idle,
                "quality_class": F.when(idle, none).otherwise(c("quality_class"))}
    return aged


def fold_actors(films: DataFrame, first: int, last: int, carry_class: bool = False, at_once: int = 1) -> DataFrame:
    """All snapshots first..last built year by year; a year writes its own actors."""
    src = stage_by_period(films, "year")
    return fold_changes(_empty_actors(src), range(first, last + 1), "actor", "year",
                        lambda yr, to=None: _films_of_year(src.where(F.col("year").between(yr, yr if to is None else to))),
                        _actors_row(carry_class), _actors_aged(carry_class), at_once=at_once)


def backfill_actors(films: DataFrame, hi: Column | int | None = None) -> DataFrame:
    """The folded ``actors`` table for every year in one pass."""
    hi = F.lit(hi) if isinstance(hi, int) else hi
    if hi is None:
        hi = films.select(F.max("year")).scalar()
    per_year = films.groupBy("actor", "year").agg(
        F.array_sort(F.collect_list(film_struct())).alias("fs"), exact_avg("rating").alias("avg_rating"))
    per_actor = per_year.groupBy("actor").agg(
        F.min("year").alias("first_year"),
        F.array_sort(F.collect_list(F.struct("year", "avg_rating", "fs"))).alias("years"))
    grid = per_actor.select("actor", "years",
                            F.explode(F.sequence("first_year", hi)).alias("year"))
    grid = grid.withColumn("year", F.col("year").cast("int"))
    upto = F.filter("years", lambda x: x["year"] <= F.col("year"))
    cur = F.try_element_at(F.filter("years", lambda x: x["year"] == F.col("year")), F.lit(1))
    return grid.select(
        "actor", "year",
        F.flatten(F.transform(upto, lambda x: x["fs"])).alias("films"),
        quality_class(cur["avg_rating"]).alias("quality_class"),
        F.col("year").alias("current_year"),
        cur.isNotNull().alias("is_active"))
