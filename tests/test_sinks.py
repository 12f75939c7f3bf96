from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from snapfold.sources import sinks


def test_upsert_frames(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(sinks.upsert_frames(old, new, ["k"]).collect()) == sorted(
        spark.createDataFrame([(1, "a"), (2, "B"), (3, "C")], "k int, v string").collect())


def test_upsert_table_and_delete(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, ["k"])
    out = sinks.upsert(spark, spark.createDataFrame([(2, "B")], "k int, v string"), path, ["k"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, "B")]
    sinks.delete_all(spark, out.schema, path)
    assert spark.read.parquet(path).count() == 0


def test_upsert_asks_the_paths_own_file_system(spark, tmp_path):
    """A path without a scheme is looked up on the default file system, not on
    the driver's disk: there it does not exist, and the rows must not be lost."""
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.warehouse.link./tables", f"file://{tmp_path}")
    conf.set("fs.defaultFS", "viewfs://warehouse/")
    try:
        path = "/tables/t"
        sinks.upsert(spark, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, ["k"])
        assert sinks.table_exists(spark, path) and not os.path.exists(path)
        for _ in range(2):  # a re-run changes nothing
            out = sinks.upsert(spark, spark.createDataFrame([(2, "B")], "k int, v string"), path, ["k"])
            assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, "B")]
        assert os.listdir(tmp_path) == ["t"]  # nothing is left beside the table
    finally:
        conf.set("fs.defaultFS", before)


def test_failing_upsert_keeps_the_table(spark, tmp_path):
    path = tmp_path / "t"
    sinks.upsert(spark, spark.createDataFrame([(1, "a")], "k int, v string"), str(path), ["k"])
    (path / "part-broken.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception, match="(?i)parquet"):
        sinks.upsert(spark, spark.createDataFrame([(2, "b")], "k int, v string"), str(path), ["k"])
    (path / "part-broken.parquet").unlink()
    assert [tuple(r) for r in spark.read.parquet(str(path)).collect()] == [(1, "a")]


def test_partitioned_upsert_touches_its_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, v string, m string"
    sinks.upsert(spark, spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], schema), path, ["k", "m"], ["m"])
    kept = os.stat(f"{path}/m=x").st_mtime_ns, sorted(os.listdir(f"{path}/m=x"))
    for _ in range(2):
        out = sinks.upsert(spark, spark.createDataFrame([(2, "B", "y"), (3, "c", "y")], schema), path,
                           ["k", "m"], ["m"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "y")]
    assert (os.stat(f"{path}/m=x").st_mtime_ns, sorted(os.listdir(f"{path}/m=x"))) == kept
    with pytest.raises(ValueError):
        sinks.upsert(spark, out, path, ["k"], ["m"])


def test_create_append_and_delete(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    sinks.create_table_as(one, path)
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.create_table_as(one, path)
    sinks.append(one, path)
    assert spark.read.parquet(path).count() == 2
    sinks.delete_all(spark, one.schema, path)
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).schema == one.schema


def test_fold_and_staging_write_about_one_file_a_period(spark):
    from snapfold.operators.cumulative import fold_periods
    from snapfold.session import clear_scratch, scratch_path, stage_by_period
    df = spark.range(3000).select((F.col("id") % 10).cast("int").alias("d"), "id").repartition(8)
    staged = stage_by_period(df, "d")
    assert len(staged.inputFiles()) <= 2 * 10
    snaps = fold_periods(df.limit(0), range(6), lambda prev, d: prev.union(staged.where(F.col("d") == d).select("d", "id")))
    assert len(snaps.inputFiles()) <= 2 * 6 and snaps.count() == 300 * (1 + 2 + 3 + 4 + 5 + 6)
    path = scratch_path(spark, "left")
    df.write.parquet(path)
    clear_scratch(spark)
    assert not os.path.exists(path.removeprefix("file:"))


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "p")
    day1 = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01")], "k int, d string")
    day2 = spark.createDataFrame([(3, "2024-01-02")], "k int, d string")
    sinks.overwrite_partitions(day1, path, ["d"])
    sinks.overwrite_partitions(day2, path, ["d"])
    sinks.overwrite_partitions(day2, path, ["d"])  # re-run of one period
    assert spark.read.parquet(path).count() == 3


def test_constraints(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, v string")
    with pytest.raises(sinks.ConstraintError):
        sinks.assert_unique(df.where(F.col("k").isNotNull()), ["k"])
    with pytest.raises(sinks.ConstraintError):
        sinks.assert_not_null(df, ["k"])
    with pytest.raises(sinks.ConstraintError):
        sinks.assert_allowed(df, "v", ["x", "y"])
    sinks.assert_unique(df.where(F.col("v") != "y").where(F.col("k").isNotNull()), ["k"])
    sinks.assert_allowed(df, "v", ["x", "y", "z"])
