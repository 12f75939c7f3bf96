"""Growth accounting (daily and weekly user states) and retention curves."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.functions.pgcompat import days_between, pg_dow
from snapfold.operators.cumulative import Row, fold_changes, prefixed
from snapfold.operators.datelists import each_day

# Growth states.
NEW, RETAINED, RESURRECTED, CHURNED, STALE = "New", "Retained", "Resurrected", "Churned", "Stale"
ACTIVE_STATES = (RETAINED, RESURRECTED, NEW)

GROWTH_COLUMNS = ("user_id", "first_active_date", "last_active_date", "daily_active_state",
                  "weekly_active_state", "dates_active", "date")


def growth_step(prev: DataFrame, today: DataFrame, churn_first: bool = False) -> DataFrame:
    """One day of ``users_growth_accounting`` (first match wins):

    daily: New (no history) / Retained (active yesterday) / Resurrected /
    Churned (inactive today, active yesterday) / Stale.
    weekly, as written: New / Retained (last active within 7 days of
    yesterday, also when absent today) / Resurrected / Churned (unreachable) /
    Stale. ``churn_first`` tests weekly Churned before Retained, so it can
    be reached.
    ``today`` = (user_id, today_date) of the day's active users."""
    t = today.select(F.col("user_id").cast("string").alias("t_user_id"), F.col("today_date").alias("t_today_date"))
    y = prev.select(*[F.col(c).alias("y_" + c) for c in GROWTH_COLUMNS])
    return t.join(y, F.col("t_user_id") == F.col("y_user_id"), "full_outer") \
        .select(*_growth_row(churn_first)(prefixed("t_"), prefixed("y_")))


def _growth_row(churn_first: bool) -> Row:
    """The new state from today's row and the snapshot of the day before."""
    return lambda t, y: _grown(t, y, churn_first)


def _grown(t, y, churn_first: bool) -> list[Column]:
    td, ylast, ydate = t("today_date"), y("last_active_date"), y("date")
    no_prev, active = y("user_id").isNull(), t("user_id").isNotNull()
    daily = (F.when(no_prev & active, NEW)
              .when(ylast == F.date_sub(td, 1), RETAINED)
              .when(ylast < F.date_sub(td, 1), RESURRECTED)
              .when(td.isNull() & (ylast == ydate), CHURNED)
              .otherwise(STALE))
    churned = td.isNull() & (ylast == ydate)
    if churn_first:
        weekly = (F.when(no_prev, NEW).when(churned, CHURNED).when(ylast >= F.date_sub(ydate, 7), RETAINED)
                   .when(ylast < F.date_sub(td, 7), RESURRECTED).otherwise(STALE))
    else:
        weekly = (F.when(no_prev, NEW).when(ylast >= F.date_sub(ydate, 7), RETAINED)
                   .when(ylast < F.date_sub(td, 7), RESURRECTED).when(churned, CHURNED).otherwise(STALE))
    empty = F.array().cast("array<date>")
    return [
        F.coalesce(t("user_id"), y("user_id")).alias("user_id"),
        F.coalesce(y("first_active_date"), td).alias("first_active_date"),
        F.coalesce(td, ylast).alias("last_active_date"),
        daily.alias("daily_active_state"),
        weekly.alias("weekly_active_state"),
        F.concat(F.coalesce(y("dates_active"), empty),
                 F.when(active, F.array(td)).otherwise(empty)).alias("dates_active"),
        F.coalesce(td, F.date_add(ydate, 1)).alias("date")]


def _growth_aged(churn_first: bool):
    """Days on which a user is absent: what ``growth_step`` says of them follows from the
    day and the last active one."""
    def aged(c, at):
        last, here = c("last_active_date"), at == c("date")
        left = last == F.date_sub(at, 1)
        weekly = F.when(here, c("weekly_active_state"))
        weekly = (weekly.when(left, CHURNED) if churn_first else weekly).when(last >= F.date_sub(at, 8), RETAINED)
        return {"date": at, "weekly_active_state": weekly.otherwise(STALE),
                "daily_active_state": F.when(here, c("daily_active_state")).when(left, CHURNED).otherwise(STALE)}
    return aged


def fold_growth(daily: DataFrame, first: dt.date, last: dt.date, churn_first: bool = False, at_once: int = 1) -> DataFrame:
    """All snapshots first..last, day by day; a day writes the users that it saw.
    ``daily`` = (user_id, date) rows, staged by date."""
    empty = daily.limit(0).select(
        F.col("user_id").cast("string").alias("user_id"), F.col("date").alias("first_active_date"),
        F.col("date").alias("last_active_date"), F.lit("").alias("daily_active_state"),
        F.lit("").alias("weekly_active_state"), F.array("date").alias("dates_active"), "date")
    today = lambda d, to=None: daily.where(F.col("date").between(F.lit(d), F.lit(to or d))).select(
        F.col("user_id").cast("string").alias("user_id"), F.col("date").alias("today_date"))
    return fold_changes(empty, each_day(first, last), "user_id", "today_date", today,
                        _growth_row(churn_first), _growth_aged(churn_first), at_once=at_once)


def growth_backfill(daily: DataFrame, end: Column, churn_first: bool = False) -> DataFrame:
    """Every (user, day) row of the folded table in one pass, from the sorted
    list of active days: pl = last active day before the day."""
    per = daily.groupBy("user_id").agg(F.min("date").alias("first"),
                                       F.sort_array(F.collect_set("date")).alias("days"))
    grid = per.select(F.col("user_id").cast("string").alias("user_id"), "first", "days",
                      F.explode(F.sequence("first", end)).alias("date"))
    d = F.col("date")
    upto = F.filter("days", lambda x: x <= d)
    before = F.filter("days", lambda x: x < d)
    g = grid.select("user_id", "first", "date", upto.alias("dates_active"),
                    F.array_contains("days", d).alias("active"),
                    F.array_max(before).alias("pl"))
    pl, active = F.col("pl"), F.col("active")
    yday = F.date_sub(d, 1)
    daily_state = (F.when(d == F.col("first"), NEW)
                    .when(active & (pl == yday), RETAINED)
                    .when(active, RESURRECTED)
                    .when(pl == yday, CHURNED)
                    .otherwise(STALE))
    weekly_state = F.when(d == F.col("first"), NEW)
    if churn_first:
        weekly_state = weekly_state.when(~active & (pl == yday), CHURNED)
    weekly_state = (weekly_state.when(pl >= F.date_sub(d, 8), RETAINED)
                                .when(active, RESURRECTED)
                                .otherwise(STALE))
    return g.select("user_id", F.col("first").alias("first_active_date"),
                    F.array_max("dates_active").alias("last_active_date"),
                    daily_state.alias("daily_active_state"), weekly_state.alias("weekly_active_state"),
                    "dates_active", "date")


def growth_by_date(df: DataFrame) -> DataFrame:
    return df.groupBy("date", "daily_active_state").agg(F.count(F.lit(1)).alias("num_users"))


def retention(df: DataFrame, cohort=None) -> DataFrame:
    """Share of a signup cohort active N days after signup, with the cohort's
    day of week (Sunday = 0). ``cohort`` = one first-active date, or None for
    every cohort."""
    if cohort is not None:
        df = df.where(F.col("first_active_date") == F.lit(cohort))
    n = F.count(F.lit(1))
    act = F.count(F.when(F.col("daily_active_state").isin(*ACTIVE_STATES), 1))
    return (df.groupBy("first_active_date",
                       days_between("date", "first_active_date").alias("days_since_signup"),
                       pg_dow("first_active_date").alias("dow"))
              .agg((act.cast("double") / n).alias("pct_active"), n.alias("num_users")))
