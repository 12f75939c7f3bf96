"""Range join: rows of two tables with ``low <= point <= high``.

Spark plans a join on inequalities alone as a nested loop over all pairs. Here both
sides are cut into bins and joined on the bin: an equi-join, shuffled like any other,
with the inequality as a residual predicate. The bins' width follows the range: a range
lies in the bins of the level whose width is its length rounded up to a power of two, so
it covers at most two of them however long it is, and a point has one bin on each level
that some range has (at most some 64). A pair therefore meets in exactly one bin: the
point's bin on the range's level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.functions.hot import BLOCK, grid_join

_LEVEL, _BIN = "_level", "_bin"
TOP = 62            # the level of ranges longer than 2^62 units: one bin holds all points


def _level(low: Column, high: Column, unit: float) -> Column:
    length = F.greatest((high.cast("double") - low.cast("double")) / F.lit(unit), F.lit(1.0))
    return F.when(length <= F.lit(float(2 ** (TOP - 1))), F.ceil(F.log2(length))).otherwise(F.lit(TOP)).cast("int")


def _bin(x: Column, level: Column, unit: float) -> Column:
    """The bin's number: a step function of ``x`` that never falls, on either side."""
    width = F.pow(F.lit(2.0), level.cast("double")) * F.lit(unit)
    return F.when(level == TOP, F.lit(0)).otherwise(F.floor(x.cast("double") / width)).cast("long")


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str,
               keys: list[str] | None = None, unit: float = 1.0, block: int = BLOCK) -> DataFrame:
    """Inner join on ``low <= point <= high`` (and equal ``keys``): the columns of
    ``points``, then those of ``ranges``, which share no name but the keys.

    Empty ranges (low > high), nulls and NaN match nothing; repeated rows give repeated
    pairs. ``unit`` is the narrowest bin, at best the length of a short range. A crowded
    bin is cut into a grid (``hot.grid_join``). Both inputs are read more than once."""
    keys = list(keys or [])
    number = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    r = ranges.where(number(low) & number(high) & (F.col(low) <= F.col(high)))
    r = r.withColumn(_LEVEL, _level(F.col(low), F.col(high), unit))
    levels = sorted(x[0] for x in r.select(_LEVEL).distinct().collect())
    first, last = (_bin(F.col(c), F.col(_LEVEL), unit) for c in (low, high))
    r = r.withColumn(_BIN, F.explode(F.sequence(first, last)))
    p = points.where(number(point)).withColumn(
        _LEVEL, F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    p = p.withColumn(_BIN, _bin(F.col(point), F.col(_LEVEL), unit))
    pairs = grid_join(p, r, [*keys, _LEVEL, _BIN], [F.col(c) for c in points.columns],
                      [F.col(c) for c in ranges.columns], block)
    return pairs.where((F.col(low) <= F.col(point)) & (F.col(point) <= F.col(high))).select(
        *points.columns, *[c for c in ranges.columns if c not in keys])
