"""Registered queries: each key builds one report from the fixture tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
columns are scalar and named exactly as in ``plans/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def report_types(df: DataFrame) -> DataFrame:
    """Registered outputs carry no DATE columns: a date becomes the
    TIMESTAMP_NTZ of its midnight (the oracles cast the same way), so both
    engines hand over the same temporal type."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DateType
    if not any(isinstance(f.dataType, DateType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, DateType) else F.col(f.name)
                       for f in df.schema.fields])


def query(name: str):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return report_types(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


MODULES = ("q_cubes", "q_facts", "q_sequences", "q_cumulative", "q_scd", "q_graph",
           "q_datelists", "q_growth", "q_web", "q_streaming", "q_sinks", "q_tables")


def load_all() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # importing the modules registers their queries and oracles
    import importlib
    for m in MODULES:
        importlib.import_module(f"snapfold.plans.{m}")
    return dict(QUERIES)
