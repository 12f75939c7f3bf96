"""Every registered query against its DuckDB oracle on the smallest scale."""
from __future__ import annotations

import pytest

import __spark_entry__ as entry
from snapfold.plans import oracle, registry
from tools.oracle_check import compare, duck

QUERIES = registry.load_all()
ORACLE = oracle.load_all()


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, sf_dir, con, name):
    ok, msg = compare(spark, name, QUERIES[name], ORACLE[name], sf_dir, con)
    assert ok, msg


def test_entry_has_them_all():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_without_the_training_data_package(tmp_path):
    """The driver removes llm folders and the pipeline: the rest still imports."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py"))
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
            "assert set(q) == set(o) and not any(k.startswith('op') or k == 'pipeline' for k in q); print(len(q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True,
                         env=os.environ | {"PYTHONPATH": str(tmp_path / "repo")})
    assert out.returncode == 0 and int(out.stdout) == len(QUERIES), out.stderr


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["referrer", "browser_type", "os_type", "number_of_site_hits",
                          "number_of_signup_visits", "number_of_contact_visits",
                          "number_of_login_visits", "pct_visited_signup"]
    assert len(rows) > 0
    pct = [r["pct_visited_signup"] for r in rows]
    assert pct == sorted(pct, reverse=True)


@pytest.mark.parametrize("name", ["stream_hourly", "host_share", "session_avg", "page_transitions",
                                  "fct_game_details"])
def test_session_time_zone_does_not_matter(spark, sf_dir, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")  # +05:30: hours off UTC hours
    try:
        ok, msg = compare(spark, name, QUERIES[name], ORACLE[name], sf_dir, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ok, msg
