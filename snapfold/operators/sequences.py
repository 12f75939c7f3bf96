"""Sequence analytics: moving-window wins, gaps-and-islands streaks and
page-to-page transition times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.functions.hot import grid_join, split_heavy
from snapfold.functions.ordinals import dense_within, ordinal_within
from snapfold.functions.pgcompat import wall_micros
from snapfold.session import cut_lineage

GAME_BUCKET = 4096  # game ids per bucket when numbering rows within a team/player
ROWS = 16384        # rows per block when a moving sum looks back
BLOCK = 16          # instants of a user-day whose events meet pair by pair


def _bucket(c: str, size: int) -> Column:
    return F.floor(F.col(c) / F.lit(size))


def rolling_sum_top(df: DataFrame, key: str, order: list[str], value: Column, n: int = 90,
                    out: str = "max_wins_in_90_game_stretch", bucket_col: str = "game_id",
                    bucket_size: int = GAME_BUCKET) -> DataFrame:
    """Best sum of ``value`` over ``n`` consecutive rows of one ``key``
    (``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW``), top-1 over keys.

    Row r's value counts in the windows that end at rows r .. r+n-1, so with S
    the running sum the moving sum at r is S(r) - S(r-n). Rows are cut into blocks by
    number, the last n of a block also go with the next one, and S(r-n) is read n rows
    back there: one sort, no self join and no table of sums in memory; row numbers
    and running sums come from bucketed windows (``ordinal_within``), so no task
    ever holds a whole team."""
    numbered = ordinal_within(df.select(key, *order, value.alias("_v")), [key],
                              [F.col(c).asc_nulls_last() for c in order],
                              _bucket(bucket_col, bucket_size), running={"_s": F.col("_v")})
    size = max(n, ROWS)
    own = F.floor((F.col("rn") - 1) / F.lit(size))
    parts = numbered.select(key, "rn", "_s", own.alias("_own"), F.explode(F.when(
        own != F.floor((F.col("rn") - 1 + n) / F.lit(size)), F.array(own, own + 1)).otherwise(F.array(own))).alias("_block"))
    back = F.lag("_s", n).over(Window.partitionBy(key, "_block").orderBy("rn"))
    moving = (parts.withColumn(out, F.col("_s") - F.coalesce(back, F.lit(0)))
                   .where(F.col("_own") == F.col("_block")))
    best = moving.groupBy(key).agg(F.max(out).alias(out))
    return best.orderBy(F.col(out).desc(), F.col(key).asc()).limit(1)


def longest_streak(df: DataFrame, key: str, order: list[str], pred: Column,
                   out: str = "longest_streak_with_10_or_more_pts", bucket_col: str = "game_id",
                   bucket_size: int = GAME_BUCKET, only: str | None = None,
                   top: int | None = None) -> DataFrame:
    """Longest run of consecutive rows (per ``key`` in ``order``, NULLs last)
    where ``pred`` holds: number all rows, number the qualifying rows again,
    equal difference = one island; its length is COUNT(bucket_col), so a row
    without a game id joins a run but is not counted. A NULL predicate breaks a
    run. ``only`` reports one key, ``top`` the longest runs.

    The difference is the number of rows so far that do not qualify: one window, and
    one shuffle, for the keys that fit a task (``split_heavy``). Rows of heavy keys are
    numbered by bucket, twice; the second numbering orders by the first one (unique),
    so rows that tie on ``order`` are numbered consistently in both passes."""
    order_cols = [F.col(c).asc_nulls_last() for c in order]
    base = (df if only is None else df.where(F.col(key) == only)).select(key, *order, pred.alias("_ok"))
    light, heavy = split_heavy(base, [key])

    def longest(hits: DataFrame, island: Column) -> DataFrame:
        islands = hits.groupBy(key, island.alias("_grp")).agg(F.count(bucket_col).alias(out))
        return islands.groupBy(key).agg(F.max(out).cast("bigint").alias(out))

    so_far = Window.partitionBy(key).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    broken = F.sum(F.when(F.col("_ok"), 0).otherwise(1)).over(so_far)
    best = longest(light.withColumn("_broken", broken).where("_ok"), F.col("_broken"))
    if heavy is not None:
        all_rn = ordinal_within(heavy, [key], order_cols, _bucket(bucket_col, bucket_size), name="rn")
        hits = all_rn.where(F.col("_ok"))
        both = ordinal_within(hits, [key], [F.col("rn")], _bucket(bucket_col, bucket_size), name="rn2")
        best = best.unionByName(longest(both, F.col("rn") - F.col("rn2")))
    return best if top is None else best.orderBy(F.col(out).desc(), F.col(key).asc_nulls_last()).limit(top)


def _micros_between(later: str, earlier: str) -> Column:
    return wall_micros(later) - wall_micros(earlier)


def page_transitions(combined: DataFrame, min_users: int | None = 100, bucket_seconds: int = 60,
                     block: int = BLOCK) -> DataFrame:
    """Fastest move from ``from_url`` to ``to_url`` per user within a day, then
    per url pair: users, min, max and mean seconds; HAVING users > min_users.

    The reference self-joins all earlier same-day events of a user (all pairs of a
    user-day). Here the instants of a user-day are numbered (``dense_within``) and cut
    into blocks of ``block``; pairs of events meet within a block only. Above the blocks
    lies a binary tree: the fastest move over the middle of a node goes from the last
    event of ``from_url`` in its left half to the first of ``to_url`` in its right half,
    and each pair of instants of different blocks lies on both sides of exactly one
    node's middle. So what is shuffled is an event per level of its user-day's tree,
    combined map-side to the distinct urls of a half, and what the nodes join is reduced
    to one gap per user and url pair before it moves on. A busy user-day has as many
    keys as nodes; a node with many urls is cut into a grid (``hot.grid_join``)."""
    ev = (combined.where(F.col("user_id").isNotNull() & F.col("event_time").isNotNull())
                  .select("user_id", F.to_date("event_time").alias("day"), F.col("event_time").alias("t"), "url"))
    second_of_day = F.hour("t") * 3600 + F.minute("t") * 60 + F.second("t")
    # stored once: read by the blocks and by the tree
    at = cut_lineage(dense_within(ev, ["user_id", "day"], "t", F.floor(second_of_day / F.lit(bucket_seconds)), "nth", "n")
                     .withColumn("block", F.floor((F.col("nth") - 1) / F.lit(block))), "parquet")
    left = at.select("user_id", "day", "block", F.col("url").alias("from_url"), F.col("t").alias("prev_t"))
    right = at.select("user_id", "day", "block", F.col("url").alias("to_url"), "t")
    near = left.join(right, ["user_id", "day", "block"]).where("t > prev_t")
    # a node of level k spans 2^k blocks; a left half without a right one has no moves
    blocks = F.floor((F.col("n") - 1) / F.lit(block)) + 1
    halves = (at.where(F.col("n") > block)
                .select("user_id", "day", "url", "t", "block", blocks.alias("blocks"), F.explode(F.sequence(
                    F.lit(1), F.ceil(F.log2(blocks)).cast("int"))).alias("level"))
                .withColumn("half", F.expr("shiftright(block, level - 1)"))
                .where("half % 2 = 1 OR shiftleft(half + 1, level - 1) < blocks")
                .select("user_id", "day", "level", F.expr("shiftright(half, 1)").alias("node"),
                        F.expr("half % 2 = 1").alias("late"), "url", "t"))
    node = ["user_id", "day", "level", "node"]
    ends = cut_lineage(halves.groupBy(*node, "late", "url").agg(F.min("t").alias("first_t"), F.max("t").alias("last_t")),
                       "parquet")
    far = grid_join(ends.where("not late").select(*node, F.col("url").alias("from_url"), F.col("last_t").alias("prev_t")),
                    ends.where("late").select(*node, F.col("url").alias("to_url"), F.col("first_t").alias("t")),
                    node, [F.col("from_url")], [F.col("to_url")])
    # gaps in integer microseconds: the mean is an exact integer sum / count,
    # the same in any engine and any summation order
    move = ["user_id", "to_url", "from_url"]
    gap = _micros_between("t", "prev_t").alias("gap")
    per_user = near.select(*move, gap).unionByName(far.select(*move, gap)).groupBy(*move).agg(F.min("gap").alias("gap"))
    n = F.count(F.lit(1))
    out = per_user.groupBy("to_url", "from_url").agg(
        n.alias("num_users"),
        (F.min("gap") / F.lit(1e6)).alias("min_seconds"),
        (F.max("gap") / F.lit(1e6)).alias("max_seconds"),
        (F.sum("gap") / n / F.lit(1e6)).alias("avg_seconds"))
    if min_users is not None:
        out = out.where(F.col("num_users") > min_users)
    return out
