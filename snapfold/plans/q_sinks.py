"""Stored loads: each query builds a table with the sinks and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapfold.operators import cubes
from snapfold.operators import datelists as dl
from snapfold.plans.oracle import ORACLE, oracle
from snapfold.plans.q_datelists import last_day
from snapfold.plans.registry import query
from snapfold.session import scratch_path
from snapfold.sources import fixtures as fx
from snapfold.sources import sinks


@query("load_append")
def load_append(spark, sf_dir):
    """INSERT INTO ... SELECT, in two loads: the days before the last, then the
    rest (the last day and events without a time)."""
    ev = fx.fx_processed_events(spark, sf_dir)
    path = scratch_path(spark, "processed_events")
    old = dl.before_day("event_timestamp", last_day(ev, "event_timestamp"))
    sinks.append(ev.where(old), path)
    sinks.append(ev.where(~F.coalesce(old, F.lit(False))), path)
    return spark.read.schema(ev.schema).parquet(path)


oracle("load_append", "SELECT * FROM fx_processed_events")


@query("load_create_table_as")
def load_create_table_as(spark, sf_dir):
    """The grouping-sets dashboard stored with CREATE TABLE AS."""
    board = cubes.web_dashboard(fx.fx_events(spark, sf_dir), fx.fx_devices(spark, sf_dir), mode="sets")
    path = scratch_path(spark, "web_dashboard")
    sinks.create_table_as(board, path)
    return spark.read.parquet(path)


@query("load_delete_and_insert")
def load_delete_and_insert(spark, sf_dir):
    """DELETE FROM, then INSERT: a reload leaves the rows once."""
    teams = fx.fx_teams(spark, sf_dir)
    path = scratch_path(spark, "teams")
    sinks.append(teams, path)
    sinks.delete_all(spark, teams.schema, path)
    sinks.append(teams, path)
    return spark.read.schema(teams.schema).parquet(path)


oracle("load_delete_and_insert", "SELECT * FROM fx_teams")


def same_oracle(key, of):
    ORACLE[key] = ORACLE[of]


same_oracle("load_create_table_as", "dashboard_grouping_sets")
