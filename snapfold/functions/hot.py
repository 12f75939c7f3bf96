"""Joins in which one key may hold any share of the rows.

A hash join puts all rows of a key into one task. Here the keys that hold more than a
``SHARE``-th of the rows are counted first - there are at most ``SHARE`` of them, however
large the table, so they can be broadcast - and their rows never meet a shuffle on the
key. No row is dropped, capped or sampled, and nothing depends on random numbers, so a
task that is run again deals its rows out as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.session import cut_lineage

SHARE = 1000        # a key with more than this part of all rows is heavy: at most so many keys
LEAST = 256         # and none with fewer rows
BLOCK = 1024        # rows of a crowded key in one cell of a pair join, on average
SLOTS = 8192        # hashes of keys that are counted where the keys themselves are too many

_N, _ROW, _COL = "_rows_of_key", "_grid_row", "_grid_column"


def heavy_keys(df: DataFrame, keys: list[str], least: int = LEAST, share: int = SHARE) -> DataFrame | None:
    """(keys, rows) of the keys that hold over ``least`` rows and over a ``share``-th of
    all, as a local table of at most ``share`` rows; None where there are none. Rows with
    a null in the key are counted with no key: an inner join never matches them."""
    whole = df.select(*keys).dropna()
    total = whole.count()
    over = max(least, total // share)
    found = whole.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N)).where(F.col(_N) > over)
    rows = found.collect()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def heavy_of(counts: DataFrame, keys: list[str], n: str, least: int = LEAST, share: int = SHARE) -> DataFrame | None:
    """``heavy_keys`` from a stored table (keys, n) of the rows of every key."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    found = counts.where(F.col(n) > max(least, total // share)).select(*keys, F.col(n).alias(_N))
    rows = found.collect()
    return counts.sparkSession.createDataFrame(rows, found.schema) if rows else None


def split_heavy(df: DataFrame, keys: list[str], least: int = LEAST,
                share: int = SHARE) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``df`` in two parts without a key in common: ordinary keys, each with at
    most a ``share``-th of all rows, and the rest, None where there are none. NULL is a key.

    Rows are counted by a hash of the key in ``SLOTS`` slots, so a task passes on that many
    counts and no rows; all keys of a slot over the limit go to the second part."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS))
    rows = dict(df.groupBy(slot.alias("slot")).count().collect())
    over = max(least, sum(rows.values()) // share)
    heavy = [s for s, n in rows.items() if n > over]
    return (df.where(~slot.isin(heavy)), df.where(slot.isin(heavy))) if heavy else (df, None)


def join_unique(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
                least: int = LEAST, share: int = SHARE, counts: DataFrame | None = None) -> DataFrame:
    """``big`` joined (inner or left) with the narrow table ``small``, in which ``keys`` are
    unique. The rows of heavy keys of ``big`` stay where they are and meet the at most
    ``share`` rows of ``small`` by broadcast; all others are joined by Spark's own choice.
    ``big`` is read more than once: store it first. ``counts``: a stored table (keys, n) with
    the rows of each key, where there is one already."""
    if how not in ("inner", "left"):
        raise ValueError(how)
    heavy = heavy_keys(big, keys, least, share) if counts is None else heavy_of(counts, keys, "n", least, share)
    if heavy is None:
        return big.join(small, keys, how)
    named = F.broadcast(heavy.select(*keys))
    few = small.join(named, keys, "left_semi")
    hot = big.join(named, keys, "left_semi").join(F.broadcast(few), keys, how)
    return hot.unionByName(big.join(named, keys, "left_anti").join(small, keys, how))


def cells(a: DataFrame, b: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """(keys, grid rows, grid columns) of the keys whose pairs are cut into a grid: those
    with over ``block`` rows on a side."""
    n = lambda df, name: df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    parts = lambda name: F.ceil(F.col(name) / F.lit(block)).cast("int")
    both = n(a, "_a").join(n(b, "_b"), keys).where((F.col("_a") > block) | (F.col("_b") > block))
    return both.select(*keys, parts("_a").alias(_ROW + "s"), parts("_b").alias(_COL + "s"))


def grid_join(a: DataFrame, b: DataFrame, keys: list[str], spread_a: list[Column], spread_b: list[Column],
              block: int = BLOCK, share: int = SHARE) -> DataFrame:
    """Inner equi-join on ``keys`` of two tables that both may hold many rows of a key.

    A crowded key's rows of ``a`` are dealt by a hash of ``spread_a`` over the rows of a
    grid and repeated for each of its columns, those of ``b`` the other way round: each
    pair meets in exactly one cell, and a cell holds some ``block`` rows of either side.
    The other keys have one cell. ``spread_a`` and ``spread_b`` should tell a key's rows
    apart; the two tables share no column but the keys, and are read more than once."""
    size = cut_lineage(cells(a, b, keys, block), "parquet")
    if size.isEmpty():
        return a.join(b, keys)

    def dealt(df: DataFrame, spread: list[Column], own: str, other: str) -> DataFrame:
        sized = join_unique(df, size, keys, "left", least=block, share=share)
        one = lambda c: F.coalesce(F.col(c + "s"), F.lit(1))
        return (sized.withColumn(own, F.pmod(F.xxhash64(*spread), one(own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), one(other) - 1)))
                .drop(_ROW + "s", _COL + "s"))
    return dealt(a, spread_a, _ROW, _COL).join(dealt(b, spread_b, _COL, _ROW), [*keys, _ROW, _COL]).drop(_ROW, _COL)
