from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from snapfold.session import get_spark, shared_dir
    s = get_spark("snapfold-tests", master="local[4]", shuffle_partitions=4)
    shared_dir(s)  # tests: a local folder only when the session names none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE
