"""Row numbers and running sums within a key, without one task per key.

A window partitioned by a low-cardinality key (a team, a host) puts the whole
group into one task. Here rows are cut into buckets of the leading order
column; a window over the small table of per-bucket counts gives each bucket's
offset, and a window over (key, bucket) numbers the rows inside it. Both windows
only ever hold one bucket of one key, so a key with a third of all rows is
spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.functions.joins import plain_keys, restored

_B = "_bucket"


def ordinal_within(df: DataFrame, keys: list[str], order: list[Column], bucket: Column,
                   name: str = "rn", running: dict[str, Column] | None = None) -> DataFrame:
    """Add ``name`` = 1-based row number within ``keys`` in ``order``.

    ``bucket`` must be monotone in ``order`` (e.g. ``floor(game_id / 4096)``); a
    NULL bucket comes last. ``running`` maps output names to numeric columns
    whose running sum (over rows up to and including the current one, in the
    same order) is added too."""
    running = running or {}
    null_bucket = "_no_bucket"
    values = {f"_v_{n}": c for n, c in running.items()}
    b, plain = plain_keys(df.withColumn(_B, bucket).withColumns(values)
                          .withColumn(null_bucket, F.col(_B).isNull())
                          .withColumn(_B, F.coalesce(_B, F.lit(0))), keys)
    by = [*plain, null_bucket, _B]
    inside = Window.partitionBy(*by).orderBy(*order)
    local = b.select("*", F.row_number().over(inside).alias("_lrn"),
                     *[F.sum(f"_v_{n}").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_l{n}")
                       for n in running])
    per_bucket = b.groupBy(*by).agg(F.count(F.lit(1)).alias("_cnt"),
                                    *[F.sum(f"_v_{n}").alias(f"_s{n}") for n in running])
    before = Window.partitionBy(*plain).orderBy(null_bucket, _B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *by, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        *[F.coalesce(F.sum(f"_s{n}").over(before), F.lit(0)).alias(f"_o{n}") for n in running])
    rest = [c for c in df.columns if c not in keys]
    return local.join(offsets, by).select(
        *restored(keys), *rest, (F.col("_off") + F.col("_lrn")).alias(name),
        *[(F.col(f"_o{n}") + F.col(f"_l{n}")).alias(n) for n in running])


def dense_within(df: DataFrame, keys: list[str], value: str, bucket: Column, name: str = "nth",
                 total: str = "n") -> DataFrame:
    """Add ``name`` = 1-based dense rank of ``value`` (not null) within ``keys``, ascending,
    and ``total`` = the distinct values of ``keys``. ``bucket`` must be monotone in
    ``value``. One window holds the rows of a bucket, one a row per bucket of a key."""
    b, plain = plain_keys(df.withColumn(_B, bucket), keys)
    by = [*plain, _B]
    local = b.withColumn("_lrn", F.dense_rank().over(Window.partitionBy(*by).orderBy(value)))
    per_bucket = local.groupBy(*by).agg(F.max("_lrn").alias("_cnt"))
    key = Window.partitionBy(*plain)
    before = key.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*by, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                                F.sum("_cnt").over(key).alias(total))
    rest = [c for c in df.columns if c not in keys]
    return local.join(offsets, by).select(*restored(keys), *rest, (F.col("_off") + F.col("_lrn")).alias(name), total)


RANK_WIDTH = 1024  # values of one range when ranks are counted


def rank_by_counts(df: DataFrame, keys: list[str], value: str, name: str = "rank",
                   width: int = RANK_WIDTH, only: Column | None = None,
                   counts: DataFrame | None = None) -> DataFrame:
    """``RANK() OVER (PARTITION BY keys ORDER BY value DESC NULLS FIRST)`` of a
    numeric column without a window over a partition's rows: rank = 1 + rows of
    the partition that sort before the value.

    Rows are counted per distinct value (a map-side partial aggregate). Values
    are cut into ranges of ``width``: a window over the ranges gives the rows of
    larger ranges, a window inside a range the rows of larger values there. No
    window holds more than the distinct values of one range, or the ranges of
    one partition. ``only``, a condition on other columns than ``keys`` and ``value``:
    the rows to rank; all rows count, the others are not returned. ``counts``: a stored
    table with ``keys``, ``value`` and the rows ``_n`` of each, where there is one already."""
    d, plain = plain_keys(df.withColumn("_value", F.col(value)), [*keys, value])
    group = [c for c in plain if c not in ("_key_" + value, "_null_" + value)]
    v, none = "_key_" + value, "_null_" + value
    d = d.withColumn("_range", F.floor(F.col(v) / F.lit(width)).cast("long"))
    given = d.withColumn("_n", F.lit(1)) if counts is None else plain_keys(counts, [*keys, value])[0].withColumn(
        "_range", F.floor(F.col(v) / F.lit(width)).cast("long"))
    counts = given.groupBy(*group, none, "_range", v).agg(F.sum("_n").alias("_n"))
    ranges = counts.groupBy(*group, none, "_range").agg(F.sum("_n").alias("_rn"))
    larger = Window.partitionBy(*group).orderBy(F.col(none).desc(), F.col("_range").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    above = ranges.select(*group, none, "_range", F.coalesce(F.sum("_rn").over(larger), F.lit(0)).alias("_above"))
    inside = Window.partitionBy(*group, none, "_range").orderBy(F.col(v).desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    ranks = (counts.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
             .join(above, [*group, none, "_range"])
             .select(*group, none, "_range", v, (F.col("_above") + F.col("_in") + 1).alias(name)))
    rest = [c for c in df.columns if c not in keys and c != value]
    out = (d if only is None else d.where(only)).join(ranks, [*group, none, "_range", v])
    return out.select(*restored(keys), F.col("_value").alias(value), *rest, name)
