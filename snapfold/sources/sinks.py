"""Sinks and table-level checks: append, partition overwrite, upsert, delete,
primary-key / not-null / enum checks.

Parquet has neither ``MERGE`` nor constraints, so an upsert is "new rows +
old rows whose key is not among them". It never writes over what it reads: a
partitioned table has its touched partitions replaced from a stored copy of the
merged rows, any other table is written beside the old one and swapped in by
renaming, so a failed write leaves the old table. Whether a table exists is asked
of the path's own file system, and any other error is raised. It is not atomic for
concurrent readers; a table format with row-level ``MERGE INTO`` is the place
for that.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapfold.session import file_system, scratch_path


def upsert_frames(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE``: rows of ``new`` replace
    rows of ``old`` with the same key; a null in a key equals a null (a stream's groups
    have such keys, declared ones never do)."""
    return new.unionByName(_matching(old, new, keys, "left_anti"))


def _matching(old: DataFrame, new: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows of ``old`` with ("left_semi") or without ("left_anti") a row of the same key in ``new``."""
    other = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_new_{k}"))
    return old.join(other, same, how)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there, on whatever file system ``path`` names."""
    fs, hp = file_system(spark, path)
    return bool(fs.exists(hp))


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """``INSERT INTO t SELECT``."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions present in ``df`` (one period of a
    snapshot table): re-running a period is idempotent."""
    (df.hint("rebalance", *partition_by).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def through_copy(df: DataFrame, name: str, write) -> None:
    """``write`` gets a copy of ``df`` stored in the shared folder, which goes afterwards:
    for rows that are read several times, or that come from what is to be replaced."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    write(spark.read.schema(df.schema).parquet(path))
    fs, hp = file_system(spark, path)
    fs.delete(hp, True)


def _swap(spark: SparkSession, new_path: str, path: str) -> None:
    """Puts the table at ``new_path`` in the place of that at ``path``."""
    fs, new = file_system(spark, new_path)
    _, live = file_system(spark, path)
    _, aside = file_system(spark, f"{new_path}.replaced")
    if not fs.rename(live, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, live):
        fs.rename(aside, live)
        raise OSError(f"cannot move {new_path} to {path}")
    fs.delete(aside, True)


def upsert(spark: SparkSession, new: DataFrame, path: str, keys: list[str],
           partition_by: list[str] | None = None) -> DataFrame:
    """Upsert ``new`` into the Parquet table at ``path``; returns the new table, its
    columns in the order of ``new``.

    With ``partition_by`` (columns among ``keys``, so a row never changes its
    partition) only the partitions that ``new`` touches are read and replaced."""
    if partition_by and not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    if not table_exists(spark, path):
        if partition_by:
            new.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
        else:
            new.write.parquet(path)
    elif partition_by:
        old = spark.read.schema(new.schema).parquet(path).select(*new.columns)
        touched = new.select(*partition_by).distinct()
        merged = upsert_frames(_matching(old, touched, partition_by, "left_semi"), new, keys)
        through_copy(merged, "merged", lambda rows: overwrite_partitions(rows, path, partition_by))
    else:
        beside = f"{path.rstrip('/')}._{uuid.uuid4().hex[:12]}"
        upsert_frames(spark.read.schema(new.schema).parquet(path), new, keys).write.parquet(beside)
        _swap(spark, beside, path)
    return spark.read.schema(new.schema).parquet(path).select(*new.columns)


def delete_all(spark: SparkSession, schema: StructType, path: str) -> None:
    """``DELETE FROM t``: the table keeps its schema and has no rows."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def create_table_as(df: DataFrame, path: str) -> None:
    """``CREATE TABLE t AS SELECT``."""
    df.write.mode("errorifexists").parquet(path)


class ConstraintError(ValueError):
    pass


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """PRIMARY KEY: no NULL key part and no duplicate key (one aggregation)."""
    nulls = F.count(F.when(F.greatest(*[F.col(k).isNull().cast("int") for k in keys]) == 1, 1)) \
        if len(keys) > 1 else F.count(F.when(F.col(keys[0]).isNull(), 1))
    dups = df.groupBy(*keys).count().where(F.col("count") > 1)
    r = df.agg(nulls.alias("n")).first()
    if r["n"]:
        raise ConstraintError(f"{r['n']} rows with a NULL in key {keys}")
    if dups.limit(1).count():
        raise ConstraintError(f"duplicate values of key {keys}")


def assert_not_null(df: DataFrame, cols: list[str]) -> None:
    r = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols]).first()
    bad = {c: r[c] for c in cols if r[c]}
    if bad:
        raise ConstraintError(f"NULL values: {bad}")


def assert_allowed(df: DataFrame, col: str, values) -> None:
    """Enum check: every non-NULL value is one of ``values``."""
    n = df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values))).limit(1).count()
    if n:
        raise ConstraintError(f"{col} has values outside {list(values)}")


def assert_valid(df: DataFrame, enums: dict[str, tuple[str, ...]], not_null: list[str]) -> None:
    """Enum and not-null checks of several columns in one scan."""
    wrong = {**{f"{c} outside its enum": F.col(c).isNotNull() & ~F.col(c).isin(list(v)) for c, v in enums.items()},
             **{f"{c} null": F.col(c).isNull() for c in not_null}}
    if not wrong:
        return
    r = df.agg(*[F.count(F.when(w, 1)).alias(k) for k, w in wrong.items()]).first()
    bad = {k: r[k] for k in wrong if r[k]}
    if bad:
        raise ConstraintError(f"rows in breach: {bad}")


REPORT = "table_name string, constraint_type string, columns string, violations long"


def constraint_report(df: DataFrame, name: str, key: list[str] | None = None, not_null: list[str] | None = None,
                      enums: dict[str, tuple[str, ...]] | None = None, hashed=F.xxhash64) -> DataFrame:
    """(table_name, constraint_type, columns, violations): what breaks the declarations of a
    stored table, in one scan. Key columns must not be null; of rows that share a key all
    but one are in breach; an enum column's values are among those listed, or null.

    Rows are grouped by a hash of the key, with the smallest and the largest key of each
    group (partial aggregates: a common key is no hot task). A group whose two keys are
    equal has one key; only the rows of groups that mix keys are read again, exactly."""
    spark, key, enums = df.sparkSession, list(key or []), enums or {}
    nullable = list(dict.fromkeys([*key, *(not_null or [])]))
    wrong = [("not null", c, F.col(f"`{c}`").isNull()) for c in nullable]
    wrong += [("enum", c, F.col(f"`{c}`").isNotNull() & ~F.col(f"`{c}`").isin(list(v))) for c, v in enums.items()]
    parts = [F.col(f"`{c}`") for c in key]
    whole = F.lit(True)
    for c in parts:
        whole = whole & c.isNotNull()
    rows = df.select(F.when(whole, hashed(*parts) if key else F.lit(0)).alias("h"), F.struct(*parts, F.lit(0)).alias("k"),
                     *[F.when(w, 1).otherwise(0).alias(f"w{i}") for i, (_, _, w) in enumerate(wrong)])
    each = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high"),
                                 *[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(wrong))])
    keyed, mixed = F.col("h").isNotNull(), F.col("low") != F.col("high")
    got = each.agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(wrong))],
                   F.sum(F.when(keyed & ~mixed, F.col("n") - 1)).alias("repeated"),
                   F.count(F.when(keyed & mixed, 1)).alias("mixed")).first()
    out = [(name, kind, c, got[f"w{i}"] or 0) for i, (kind, c, _) in enumerate(wrong)]
    if key:
        repeated = got["repeated"] or 0
        if got["mixed"]:
            hashes = each.where(keyed & mixed).select("h")
            exact = rows.select("h", "k").join(hashes, "h", "left_semi").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
            repeated += exact.agg(F.sum(F.col("n") - 1)).first()[0] or 0
        out.append((name, "primary key", ", ".join(key), repeated))
    return spark.createDataFrame(out, REPORT)
