"""Slowly changing dimensions, type 2, and the state-change report on them.

Windows here are partitioned by the entity (player, actor): many keys, each
holding one row per period, so partitions stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _changed(a: Column, b: Column, null_safe: bool) -> Column:
    return ~a.eqNullSafe(b) if null_safe else (a != b)


def scd2_backfill(df: DataFrame, key: str, period: str, attrs: list[str], cutoff: Column | int,
                  fixed: bool = False, start: str = "start_season", end: str = "end_season",
                  current: str = "current_season") -> DataFrame:
    """Change flags -> streak ids -> one row per streak with its first and
    last period, for periods up to ``cutoff``.

    As written the streak id is not grouped on, so separate streaks with the
    same attributes merge into one (overlapping) row, and a NULL on either side
    counts as "no change". ``fixed`` groups on the streak and compares
    null-safely."""
    cutoff = F.lit(cutoff) if isinstance(cutoff, int) else cutoff
    w = Window.partitionBy(key).orderBy(period)
    flag = None
    for a in attrs:
        cond = _changed(F.col(a), F.lag(a, 1).over(w), fixed)
        flag = F.when(cond, 1) if flag is None else flag.when(cond, 1)
    flagged = (df.select(key, period, *attrs, flag.otherwise(0).alias("change_indicator"))
                 .where(F.col(period) <= cutoff))
    streaks = flagged.withColumn("streak_identifier", F.sum("change_indicator").over(w))
    groups = [key, *attrs, *(["streak_identifier"] if fixed else [])]
    return (streaks.groupBy(*groups)
                   .agg(F.min(period).alias(start), F.max(period).alias(end))
                   .select(key, *attrs, start, end, cutoff.alias(current)))


def scd2_incremental(scd: DataFrame, snapshot: DataFrame, key: str, attrs: list[str], cutoff: Column | int,
                     *, emit_unchanged: bool, closed_row_attrs: str = "old", keep_current: bool = False,
                     null_safe: bool = False, start: str = "start_season", end: str = "end_season",
                     current: str = "current_season") -> DataFrame:
    """Next period of a type 2 dimension from the rows current at ``cutoff``
    and the entity snapshot of ``cutoff + 1``.

    One full outer join of the dimension with the snapshot: a row current at the
    cutoff meets its entity, older history meets nothing and passes through, an
    entity that meets no current row is new. Each joined row then yields its
    output rows - none, one or two - through one ``explode``.

    ``emit_unchanged``: the players script computes but never emits them.
    ``closed_row_attrs``: "new" reproduces the actors script, whose closed row
    carries the new attributes. ``keep_current`` keeps the ``current`` column.
    ``null_safe`` compares attributes with NULL-safe equality."""
    at = F.lit(cutoff) if isinstance(cutoff, int) else cutoff
    was, now = "was_", "now_"
    known = scd.where((F.col(current) == at) & (F.col(end) <= at)).select(
        *[F.col(c).alias(was + c) for c in (key, *attrs, start, end, current)], F.lit(True).alias("known"))
    seen = snapshot.where(F.col(current) == at + 1).select(
        *[F.col(c).alias(now + c) for c in (key, *attrs, current)], F.lit(True).alias("seen"))
    met = known.join(seen, (F.col(was + key) == F.col(now + key)) & (F.col(was + end) == at), "full_outer")

    same = differ = None
    for a in attrs:
        d = _changed(F.col(now + a), F.col(was + a), null_safe)
        same, differ = (~d, d) if same is None else (same & ~d, differ | d)

    def row(attr_side: str, first: str, last: str, at_: str) -> Column:
        return F.struct(*[F.col(attr_side + a).alias(a) for a in attrs], F.col(first).alias(start),
                        F.col(last).alias(end), F.col(at_).alias(current))
    as_was = row(was, was + start, was + end, was + current)
    closed = row(was if closed_row_attrs == "old" else now, was + start, was + end, was + current)
    opened = row(now, now + current, now + current, now + current)
    extended = row(now, was + start, now + current, now + current)
    nothing = F.filter(F.array(opened), lambda _: F.lit(False))
    rows = (F.when(F.col("known").isNull(), F.array(opened))
             .when(F.col(was + end) < at, F.array(as_was))
             .when(F.col("seen").isNull(), nothing)
             .when(differ, F.array(closed, opened))
             .when(same & F.lit(emit_unchanged), F.array(extended))
             .otherwise(nothing))
    return (met.select(F.coalesce(was + key, now + key).alias(key), F.explode(rows).alias("r"))
               .select(key, *[F.col("r." + c).alias(c) for c in (*attrs, start, end)],
                       *([F.col("r." + current).alias(current)] if keep_current else [])))


# Player status labels, first match wins.
NEW, RETIRED, RETURNED = "New", "Retired", "Returned from Retirement"
CONTINUED, STAYED, UNKNOWN = "Continued Playing", "Stayed Retired", "Unknown Status"


def state_change(scd: DataFrame, key: str = "player_name", start: str = "start_season",
                 active: str = "is_active") -> DataFrame:
    """Per SCD row: New / Retired / Returned from Retirement / Continued
    Playing / Stayed Retired / Unknown Status; the previous flag defaults to
    FALSE on the entity's first row."""
    w = Window.partitionBy(key).orderBy(start)
    prev = F.lag(active, 1, False).over(w)
    first = F.min(start).over(Window.partitionBy(key))
    a = F.col(active)
    status = (F.when((F.col(start) == first) & (a == F.lit(True)), NEW)
               .when((a == F.lit(False)) & (prev == F.lit(True)), RETIRED)
               .when((a == F.lit(True)) & (prev == F.lit(False)), RETURNED)
               .when((a == F.lit(True)) & (prev == F.lit(True)), CONTINUED)
               .when((a == F.lit(False)) & (prev == F.lit(False)), STAYED)
               .otherwise(UNKNOWN))
    return scd.select(key, start, status.alias("player_status"))
