from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from unilake.session import build_session, fresh_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("UNILAKE_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    # Lake writes go under spark.checkpoint.dir; work_root() picks a fresh
    # local folder only when the environment does not name one.
    s = build_session("local[4]", app="unilake-tests", shuffle_partitions=4)
    yield s


@pytest.fixture()
def lake(spark):
    from unilake.sources.landing import Lake
    for layer in ("raw", "staging", "intermediate"):   # each test's lake owns them
        spark.sql(f"DROP SCHEMA IF EXISTS {layer} CASCADE")
    return Lake(spark, fresh_dir(spark, "test-lake"))
