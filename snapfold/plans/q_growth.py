from __future__ import annotations

from pyspark.sql import functions as F

from snapfold.functions.pgcompat import render_list
from snapfold.operators import growth as gr
from snapfold.operators.cumulative import AT_ONCE
from snapfold.plans.oracle import oracle
from snapfold.plans.q_datelists import DAILY_SQL, DAY_FMT, daily, day_bounds
from snapfold.plans.registry import query
from snapfold.session import stage_by_period


def _render(df):
    return df.select("user_id", "first_active_date", "last_active_date", "daily_active_state",
                     "weekly_active_state", render_list("dates_active", DAY_FMT).alias("dates_active"), "date")


def _growth_step(churn_first):
    def run(spark, sf_dir):
        return growth_fold(spark, sf_dir, churn_first)
    return run


def growth_fold(spark, sf_dir, churn_first=False):
    """Fold over every day of the data, caught up some days a job."""
    src = stage_by_period(daily(spark, sf_dir), "date")
    return _render(gr.fold_growth(src, *day_bounds(src), churn_first=churn_first, at_once=AT_ONCE))


query("growth_step")(_growth_step(False))
query("growth_step_fixed")(_growth_step(True))


def growth_table(spark, sf_dir):
    d = daily(spark, sf_dir)
    return gr.growth_backfill(d, d.select(F.max("date")).scalar())


@query("growth_backfill")
def growth_backfill(spark, sf_dir):
    return _render(growth_table(spark, sf_dir))


# closed form of the fold: pl = last active day before the day
GROWTH_SQL = f"""WITH {DAILY_SQL},
b AS (SELECT max(date) AS hi FROM daily),
f AS (SELECT user_id, min(date) AS first FROM daily GROUP BY 1),
grid AS (SELECT f.user_id, f.first,
                CAST(unnest(generate_series(f.first, b.hi, INTERVAL 1 DAY)) AS DATE) AS date FROM f, b),
st AS (
  SELECT g.user_id, g.first, g.date,
         max(d.date) FILTER (WHERE d.date < g.date) AS pl,
         bool_or(d.date = g.date) AS active,
         max(d.date) AS last_active,
         list_sort(list(d.date)) AS upto
  FROM grid g JOIN daily d ON d.user_id = g.user_id AND d.date <= g.date
  GROUP BY g.user_id, g.first, g.date),
growth AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, first AS first_active_date, last_active AS last_active_date,
         CASE WHEN date = first THEN 'New'
              WHEN active AND pl = date - 1 THEN 'Retained'
              WHEN active THEN 'Resurrected'
              WHEN pl = date - 1 THEN 'Churned'
              ELSE 'Stale' END AS daily_active_state,
         CASE WHEN date = first THEN 'New'
              WHEN pl >= date - 8 THEN 'Retained'
              WHEN active THEN 'Resurrected'
              ELSE 'Stale' END AS weekly_active_state,
         upto, date
  FROM st)
"""
GROWTH_FIXED_SQL = GROWTH_SQL.replace("""         CASE WHEN date = first THEN 'New'
              WHEN pl >= date - 8 THEN 'Retained'""", """         CASE WHEN date = first THEN 'New'
              WHEN NOT active AND pl = date - 1 THEN 'Churned'
              WHEN pl >= date - 8 THEN 'Retained'""")
assert GROWTH_FIXED_SQL != GROWTH_SQL
for key, base in (("growth_step", GROWTH_SQL), ("growth_backfill", GROWTH_SQL), ("growth_step_fixed", GROWTH_FIXED_SQL)):
    oracle(key, base + """SELECT user_id, CAST(first_active_date AS TIMESTAMP) AS first_active_date,
  CAST(last_active_date AS TIMESTAMP) AS last_active_date, daily_active_state, weekly_active_state,
  array_to_string(list_transform(upto, lambda x: strftime(x, '%Y-%m-%d')), ',') AS dates_active,
  CAST(date AS TIMESTAMP) AS date
FROM growth""")


@query("growth_by_date")
def growth_by_date(spark, sf_dir):
    return gr.growth_by_date(growth_table(spark, sf_dir)).orderBy(F.asc_nulls_last("date"), "daily_active_state")


oracle("growth_by_date", GROWTH_SQL + """SELECT CAST(date AS TIMESTAMP) AS date, daily_active_state,
  COUNT(1) AS num_users FROM growth GROUP BY 1, 2""")


@query("retention_curve")
def retention_curve(spark, sf_dir):
    return gr.retention(growth_table(spark, sf_dir))


oracle("retention_curve", GROWTH_SQL + """SELECT CAST(first_active_date AS TIMESTAMP) AS first_active_date,
  CAST(date - first_active_date AS INTEGER) AS days_since_signup,
  CAST(EXTRACT(dow FROM first_active_date) AS BIGINT) AS dow,
  CAST(COUNT(CASE WHEN daily_active_state IN ('Retained', 'Resurrected', 'New') THEN 1 END) AS DOUBLE)
    / COUNT(1) AS pct_active,
  COUNT(1) AS num_users
FROM growth GROUP BY 1, 2, 3""")
