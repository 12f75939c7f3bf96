"""Inserts by column list, constraint reports, the lattice of cuboids."""
from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapfold.operators import cubes
from snapfold.plans.registry import load_all
from snapfold.session import cut_lineage
from snapfold.sources import schemas, sinks
from tests.test_plans import plan_text


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    schema = StructType.fromDDL("k int, s array<struct<a int, b struct<x int, y string>>>, n int, flag boolean")
    schemas.declare(spark, name, schema, str(tmp_path / "t"), {"n": "7"})
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_insert_by_column_list(spark, table):
    df = spark.createDataFrame([([(("why", 1), 2)], 5, "extra"), (None, None, "extra")],
                               "s array<struct<b struct<y string, x int>, a int>>, k int, other string")
    schemas.insert_columns(df, table, ["s", "k"])
    schemas.insert_columns(spark.createDataFrame([(True, 6, 1)], "flag boolean, k int, n long"), table)
    rows = sorted((r.asDict(recursive=True) for r in spark.table(table).collect()), key=str)
    assert rows == sorted([
        {"k": 5, "s": [{"a": 2, "b": {"x": 1, "y": "why"}}], "n": 7, "flag": None},
        {"k": None, "s": None, "n": 7, "flag": None}, {"k": 6, "s": None, "n": 1, "flag": True}], key=str)


def test_what_an_insert_refuses(spark, table):
    one = spark.createDataFrame([(1, "x")], "k int, z string")
    for columns in (["k", "z"], ["k", "k"]):
        with pytest.raises(ValueError):
            schemas.insert_columns(one, table, columns)
    with pytest.raises(ValueError):                                     # a field of another name
        schemas.insert_columns(spark.createDataFrame([([(1,)],)], "s array<struct<c int>>"), table)
    with pytest.raises(Exception, match="(?i)overflow|out of range|CAST"):     # it does not fit
        schemas.insert_columns(spark.createDataFrame([(2**40,)], "k long"), table)
    with pytest.raises(sinks.ConstraintError):
        schemas.insert_columns(one, table, ["k"], required=["k", "flag"])
    schemas.insert_columns(one, table, ["k"], required=["k", "n"])      # n has a default
    with pytest.raises(sinks.ConstraintError):
        schemas.insert_columns(spark.createDataFrame([(None,)], "k int"), table, required=["k"])
    with pytest.raises(sinks.ConstraintError):
        schemas.insert_columns(one, table, ["k"], enums={"k": (2, 3)})
    assert spark.table(table).count() == 1


def test_constraint_report(spark):
    rows = [(i % 40, "abc"[i % 3], "x") for i in range(60)] + [(None, "a", "y"), (1, None, None), (None, None, "x")]
    df = spark.createDataFrame(rows, "k int, v string, e string")
    want = {("not null", "k"): 2, ("not null", "v"): 2, ("not null", "e"): 1, ("enum", "e"): 1,
            ("primary key", "k, v"): 60 - len({(i % 40, i % 3) for i in range(60)})}
    weak = lambda *c: F.pmod(F.xxhash64(*c), F.lit(3))  # noqa: E731      mixes keys: the exact second look
    for hashed in (F.xxhash64, weak):
        got = sinks.constraint_report(df, "t", ["k", "v"], ["e"], {"e": ("x",)}, hashed)
        assert {(r.constraint_type, r.columns): r.violations for r in got.collect()} == want
    none = sinks.constraint_report(df.limit(0), "t", ["k"], enums={"e": ("x",)})
    assert [r.violations for r in none.collect()] == [0, 0, 0]
    assert sinks.constraint_report(df, "t", not_null=["e"]).count() == 1


def test_registered_report_finds_the_planted_breaches(spark, sf_dir):
    got = {(r.table_name, r.constraint_type): r.violations for r in load_all()["constraint_report"](spark, sf_dir).collect()
           if r.violations}
    assert {("players", "primary key"), ("players", "enum"), ("players", "not null"), ("vertices", "enum"),
            ("vertices", "primary key")} <= set(got)


def test_lattice_equals_grouping_the_rows(spark):
    rows = [(i % 3, None if i % 5 == 0 else i % 2, "xyz"[i * i % 3], i) for i in range(90)]
    df = spark.createDataFrame(rows, "a int, b int, c string, m long")
    dims = ["a", "b", "c"]
    sets = [("a", "b"), ("c",), (), ("b", "c"), ("a", "b", "c"), ("a",)]
    finest = cut_lineage(df.groupBy(*dims).agg(F.sum("m").alias("m")), "parquet")
    got = cubes.lattice(finest, dims, sets, ["m"])
    for s in sets:
        want = df.groupBy(*s).agg(F.sum("m").alias("m")).select(*s, "m")
        mine = got.where(F.col(cubes.SET) == cubes.set_number(dims, s))
        assert sorted(mine.select(*s, "m").collect(), key=str) == sorted(want.collect(), key=str)
        assert mine.select(*[d for d in dims if d not in s]).dropna("all").count() == 0 or set(s) == set(dims)
    assert got.select(cubes.SET).distinct().count() == len(sets)
    empty = cubes.lattice(cut_lineage(finest.limit(0), "parquet"), dims, [("a",), ("a", "b")], ["m"])
    assert empty.count() == 0


def test_an_expand_reads_a_cuboid(spark, sf_dir, monkeypatch):
    """No Expand stands over the events: each reads a stored cuboid."""
    seen = []
    real = cubes.cut_lineage
    monkeypatch.setattr(cubes, "cut_lineage", lambda df, *how: seen.append(plan_text(df)) or real(df, *how))
    load_all()["dashboard_lattice"](spark, sf_dir)
    assert len(seen) >= 3 and "Expand" not in seen[0] and "events" in seen[0]
    for text in seen[1:]:
        assert "Expand" in text and "events" not in text and "table-" in text
