"""Input tables of the reference, derived deterministically from the driver's
TPC-H-like parquet tables (see FIXTURES.md).

Each builder is a pure DataFrame expression over the given tables, so every
query that reads a fixture scales with those tables. ``plans/oracle.py`` holds
the same definitions in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.sources.tables import read_table

# Host names by k % 4, and the marker comments of the details rows.
HOSTS = ("alpha.shop.example", "beta.shop.example", "blog.example", "gamma.shop.example")
COMMENTS = {1: "DNP - Coach", 2: "DND - Injury", 3: "NWT - Personal"}
# Counters of game_details that the fixture fills with l_linenumber.
SMALL_COUNTERS = ("fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast",
                  "stl", "blk", "TO", "pf")


def _case(key: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out if default is None else out.otherwise(F.lit(default))


# --------------------------------------------------------------------------- events
def events_view(events: DataFrame, pages: DataFrame, nation: DataFrame) -> DataFrame:
    """Web events with device, host, referrer, ip and geodata.

    Works on a batch or a streaming ``events`` DataFrame (stream-static joins).
    ``nation`` has 25 rows by definition, so it is broadcast; ``pages`` grows
    with the data and is left to the planner's size check.
    """
    e = events.select("event_id", "ts", "user_id", "event_type",
                      F.get_json_object("props", "$.k").cast("int").alias("k"))
    p = pages.select(F.col("page_id"), F.col("url").alias("referrer"))
    n = nation.select("n_nationkey", "n_name")
    joined = (e.join(p, (p.page_id == e.k) & (e.k % 10 != 9), "left")
               .join(F.broadcast(n), n.n_nationkey == e.user_id % 25, "inner"))
    return joined.select(
        F.col("event_id"),
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("user_id")).alias("user_id"),
        F.col("k").alias("device_id"),
        F.col("ts").alias("event_time"),
        F.concat(F.lit("/"), F.col("event_type")).alias("url"),
        _case(F.col("k") % 4, dict(enumerate(HOSTS))).alias("host"),
        F.col("referrer"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 50).cast("string")).alias("ip"),
        F.concat(F.lit('{"country":"'), F.col("n_name"), F.lit('"}')).alias("geodata"),
    )


def fx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_view(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "pages"),
                       read_table(spark, sf_dir, "nation"))


def fx_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One device per customer. Events only reference device ids 0-99, the
    join decides which devices are used."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    j = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
          .join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    return j.select(
        F.col("c_custkey").alias("device_id"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("browser_type"),
        F.when(F.col("c_custkey") % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("r_name")).alias("os_type"),
    )


def fx_processed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_view(fx_events(spark, sf_dir))


def processed_view(ev: DataFrame) -> DataFrame:
    """The stream sink row: TIMESTAMP(3) is a millisecond truncation."""
    return ev.select("ip", F.date_trunc("millisecond", "event_time").cast("timestamp_ntz").alias("event_timestamp"),
                     "referrer", "host", "url", "geodata")


# --------------------------------------------------------------------------- players
def _cents(c: str = "o_totalprice") -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def fx_player_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    agg = (o.groupBy("o_custkey", F.year("o_orderdate").cast("int").alias("season"))
            .agg(F.count(F.lit(1)).cast("int").alias("gp"),
                 F.sum(_cents()).alias("cents"),
                 F.max(_cents()).alias("mx"),
                 F.min(_cents()).alias("mn")))
    j = (agg.join(c, agg.o_custkey == c.c_custkey)
            .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    return j.select(
        F.col("c_name").alias("player_name"),
        F.col("c_mktsegment").alias("height"),
        F.col("n_name").alias("college"),
        F.col("r_name").alias("country"),
        (F.lit(1990) + F.col("c_custkey") % 5).cast("string").alias("draft_year"),
        (F.col("c_custkey") % 3).cast("string").alias("draft_round"),
        (F.col("c_custkey") % 60).cast("string").alias("draft_number"),
        F.col("season"),
        F.col("gp"),
        (F.col("cents") / F.col("gp") / F.lit(2000000)).alias("pts"),
        (F.col("mx") / F.lit(5000000)).alias("reb"),
        (F.col("mn") / F.lit(5000000)).alias("ast"),
    )


def fx_actor_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        F.col("c_name").alias("actor"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.concat(F.lit("Film#"), F.col("o_orderkey").cast("string")).alias("film"),
        F.floor("o_totalprice").cast("int").alias("votes"),
        F.round(F.col("o_totalprice") / 50000, 1).alias("rating"),
        F.col("o_orderkey").cast("string").alias("filmid"),
    )


# --------------------------------------------------------------------------- games
def fx_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").cast("int").alias("season"),
        (F.col("o_custkey") % 10).alias("home_team_id"),
        ((F.col("o_custkey") + 1) % 10).alias("visitor_team_id"),
        F.floor(F.col("o_totalprice") / 5000).cast("int").alias("pts_home"),
        F.floor(F.col("o_totalprice") / 6000).cast("int").alias("pts_away"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("home_team_wins"),
    )


def fx_details_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("int")
    counters = [F.col("l_linenumber").alias(c) for c in SMALL_COUNTERS]
    return li.select(
        F.col("l_orderkey").alias("game_id"),
        (F.col("l_suppkey") % 10).alias("team_id"),
        F.concat(F.lit("T"), (F.col("l_suppkey") % 10).cast("string")).alias("team_abbreviation"),
        F.col("l_partkey").alias("player_id"),
        F.concat(F.lit("Player#"), F.col("l_partkey").cast("string")).alias("player_name"),
        F.col("l_returnflag").alias("start_position"),
        _case(F.col("l_linenumber"), COMMENTS).alias("comment"),
        F.concat(qty.cast("string"), F.lit(":"), (F.col("l_linenumber") * 7).cast("string")).alias("min"),
        *counters,
        qty.alias("pts"),
        (qty - 25).alias("plus_minus"),
    )


def fx_game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rows plus exact copies of every 50th player's rows."""
    base = fx_details_base(spark, sf_dir)
    return base.unionByName(base.where(F.col("player_id") % 50 == 0))


def fx_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
    return j.select(
        F.col("s_suppkey").alias("team_id"),
        F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("abbreviation"),
        F.col("s_name").alias("nickname"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("Arena "), F.col("n_name")).alias("arena"),
        (F.lit(1950) + F.col("s_nationkey")).alias("yearfounded"),
    )


def fx_detail_player_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(player_name, season) of the game_details players, taken from the game
    they played in. The reference joins game_details to player_seasons on the
    name; the orders-based player_seasons fixture shares no names with the
    lineitem-based details, so this table stands in for it."""
    gd = fx_game_details(spark, sf_dir).select("game_id", "player_name")
    g = fx_games(spark, sf_dir).select("game_id", "season")
    return gd.join(g, "game_id").select("player_name", "season").distinct()
