"""Fixed schemas of the reference's tables and composite / enum types.

``CREATE TYPE`` composites become ``StructType``s, enums become string columns
plus an allowed-values check (``sinks.assert_allowed``), ``REAL`` becomes
double (sums and averages are compared across engines), ``NUMERIC`` ids and
counts become bigint, ``JSON`` a JSON string.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DateType, DoubleType, IntegerType, LongType, MapType,
                               StringType, StructField, StructType, TimestampNTZType)

from snapfold.functions.pgcompat import EDGE_TYPES, SCORING_CLASSES, VERTEX_TYPES
from snapfold.sources import sinks


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


S, I, L, D, B, DT, TS = StringType(), IntegerType(), LongType(), DoubleType(), BooleanType(), DateType(), \
    TimestampNTZType()

SEASON_STATS = _s(("season", I, True), ("gp", I, True), ("pts", D, True), ("reb", D, True), ("ast", D, True))
FILMS = _s(("film", S, True), ("votes", I, True), ("rating", D, True), ("filmid", S, True))
SCD_TYPE = _s(("scoring_class", S, True), ("is_active", B, True), ("start_season", I, True),
              ("end_season", I, True))

ENUMS = {
    "scoring_class": SCORING_CLASSES,
    "quality_class": SCORING_CLASSES,
    "vertex_type": VERTEX_TYPES,
    "edge_type": EDGE_TYPES,
}

TABLES: dict[str, StructType] = {
    "players": _s(("player_name", S, True), ("height", S, True), ("college", S, True), ("country", S, True),
                  ("draft_year", S, True), ("draft_round", S, True), ("draft_number", S, True),
                  ("season_stats", ArrayType(SEASON_STATS), True), ("scoring_class", S, True),
                  ("years_since_last_season", I, True), ("current_season", I, True), ("is_active", B, True)),
    "players_scd": _s(("player_name", S, True), ("scoring_class", S, True), ("is_active", B, True),
                      ("start_season", I, True), ("end_season", I, True), ("current_season", I, True)),
    "actors": _s(("actor", S, True), ("year", I, True), ("films", ArrayType(FILMS), True),
                 ("quality_class", S, True), ("current_year", I, True), ("is_active", B, True)),
    "actors_history_scd": _s(("actor", S, True), ("quality_class", S, True), ("is_active", B, True),
                             ("start_date", I, True), ("end_date", I, True), ("current_year", I, True)),
    "vertices": _s(("identifier", S, True), ("type", S, True), ("properties", S, True)),
    "edges": _s(("subject_identifier", S, True), ("subject_type", S, True), ("object_identifier", S, True),
                ("object_type", S, True), ("edge_type", S, True), ("properties", S, True)),
    "users_cumulated": _s(("user_id", L, True), ("dates_active", ArrayType(DT), True), ("date", DT, True)),
    "user_devices_cumulated": _s(("user_id", L, False),
                                 ("device_activity_datelist", MapType(S, ArrayType(DT)), False)),
    "hosts_cumulated": _s(("host", S, True), ("host_datelist", ArrayType(DT), True)),
    "host_activity_reduced": _s(("month", DT, False), ("host", S, False), ("hit_array", ArrayType(L), True),
                                ("unique_visitors_array", ArrayType(L), True)),
    "array_metrics": _s(("user_id", L, True), ("month_start", DT, True), ("metric_name", S, True),
                        ("metric_array", ArrayType(D), True)),
    "users_growth_accounting": _s(("user_id", S, True), ("first_active_date", DT, True),
                                  ("last_active_date", DT, True), ("daily_active_state", S, True),
                                  ("weekly_active_state", S, True), ("dates_active", ArrayType(DT), True),
                                  ("date", DT, True)),
    "fct_game_details": _s(("dim_game_date", DT, True), ("dim_season", I, True), ("dim_team_id", L, True),
                           ("dim_player_id", L, True), ("dim_player_name", S, True),
                           ("dim_start_position", S, True), ("dim_is_playing_at_home", B, True),
                           ("dim_did_not_play", B, True), ("dim_did_not_dress", B, True),
                           ("dim_not_with_team", B, True), ("m_minutes", D, True),
                           *[(m, I, True) for m in ("m_fgm", "m_fga", "m_fg3m", "m_fg3a", "m_ftm", "m_fta",
                                                    "m_oreb", "m_dreb", "m_reb", "m_ast", "m_stl", "m_blk",
                                                    "m_turnovers", "m_pf", "m_pts", "m_plus_minus")]),
    "processed_events": _s(("ip", S, True), ("event_timestamp", TS, True), ("referrer", S, True),
                           ("host", S, True), ("url", S, True), ("geodata", S, True)),
    "processed_events_aggregated": _s(("event_hour", TS, True), ("host", S, True), ("num_hits", L, True)),
    "processed_events_aggregated_source": _s(("event_hour", TS, True), ("host", S, True), ("referrer", S, True),
                                             ("num_hits", L, True)),
    "assignment_events_sessions": _s(("session_start", TS, True), ("session_end", TS, True), ("ip", S, True),
                                     ("host", S, True), ("num_hits", L, True)),
    "processed_assignment_events_source_sessions": _s(("session_start", TS, True), ("session_end", TS, True),
                                                      ("ip", S, True), ("host", S, True), ("referrer", S, True),
                                                      ("num_hits", L, True)),
}

# PRIMARY KEY declarations of the tables that have one.
PRIMARY_KEYS = {
    "players": ["player_name", "current_season"],
    "players_scd": ["player_name", "start_season"],
    "actors_history_scd": ["actor", "start_date"],
    "vertices": ["identifier", "type"],
    "edges": ["subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type"],
    "users_cumulated": ["user_id", "date"],
    "user_devices_cumulated": ["user_id"],
    "hosts_cumulated": ["host"],
    "host_activity_reduced": ["month", "host"],
    "array_metrics": ["user_id", "month_start", "metric_name"],
    "users_growth_accounting": ["user_id", "date"],
    "fct_game_details": ["dim_game_date", "dim_team_id", "dim_player_id"],
}


# Columns whose values are of an enum: table -> column -> enum.
ENUM_COLUMNS = {
    "players": {"scoring_class": "scoring_class"},
    "players_scd": {"scoring_class": "scoring_class"},
    "actors": {"quality_class": "quality_class"},
    "actors_history_scd": {"quality_class": "quality_class"},
    "vertices": {"type": "vertex_type"},
    "edges": {"subject_type": "vertex_type", "object_type": "vertex_type", "edge_type": "edge_type"},
}


def declare(spark: SparkSession, name: str, schema: StructType, path: str, defaults: dict[str, str] | None = None) -> None:
    """``CREATE TABLE name (column type [DEFAULT expression], ...)`` over Parquet at ``path``.
    ``defaults``: SQL of what a column holds where an insert leaves it out, else NULL."""
    defaults = defaults or {}
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                        + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "") for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")


def by_name(c: Column, have: DataType, want: DataType) -> Column:
    """``c`` with the fields of its structs, however deep, in the order of ``want``, found by
    name; everything else as it is. A field that is missing or left over is an error."""
    if isinstance(want, StructType) and isinstance(have, StructType):
        if sorted(have.names) != sorted(want.names):
            raise ValueError(f"fields {have.names} given for {want.names}")
        fields = [by_name(c[f.name], have[f.name].dataType, f.dataType).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.transform(c, lambda x: by_name(x, have.elementType, want.elementType))
    if isinstance(want, MapType) and isinstance(have, MapType):
        return F.transform_values(c, lambda _, v: by_name(v, have.valueType, want.valueType))
    return c


def insert_columns(df: DataFrame, name: str, columns: list[str] | None = None,
                   enums: dict[str, tuple[str, ...]] | None = None, required: list[str] | None = None) -> None:
    """``INSERT INTO name (columns) SELECT columns FROM df``: columns in any order, by name;
    those left out take the table's default. Struct fields are matched by name, values are
    stored by Spark's ANSI store assignment (a value that does not fit is an error). Values
    of ``enums`` and nulls in ``required`` are checked before anything is written; a
    required column without a default cannot be left out. ``df`` is read twice."""
    spark = df.sparkSession
    table = spark.table(name)
    columns = columns or df.columns
    unknown = [c for c in columns if c not in table.columns]
    if unknown or len(set(columns)) < len(columns):
        raise ValueError(f"columns {columns}: {unknown or 'one'} not in {name} or given twice")
    left_out = [c for c in required or [] if c not in columns and "CURRENT_DEFAULT" not in table.schema[c].metadata]
    if left_out:
        raise sinks.ConstraintError(f"no value for {left_out}")
    sinks.assert_valid(df, {c: v for c, v in (enums or {}).items() if c in columns},
                       [c for c in required or [] if c in columns])
    view = f"insert_{uuid.uuid4().hex}"
    df.select(*[by_name(F.col(f"`{c}`"), df.schema[c].dataType, table.schema[c].dataType).alias(c) for c in columns]) \
        .createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {name} ({', '.join(f'`{c}`' for c in columns)}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def create_table(spark: SparkSession, name: str, path: str):
    """``CREATE TABLE IF NOT EXISTS name (...) USING parquet LOCATION path``."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.catalog.createTable(name, path=path, source="parquet", schema=TABLES[name])


def conforms(df, name: str) -> list[str]:
    """Differences between ``df``'s columns and the table's (names, types)."""
    want = [(f.name, f.dataType.simpleString()) for f in TABLES[name].fields]
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return [f"{w} != {g}" for w, g in zip(want, got) if w != g] + (
        [f"{len(want)} columns expected, {len(got)} found"] if len(want) != len(got) else [])
