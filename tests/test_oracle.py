"""Every registered query against its DuckDB oracle at sf0.001 (the driver's check at a
smaller scale); keys without an oracle must at least run and keep a stable schema."""

from __future__ import annotations

import os

import pytest

from tidemark.plans.catalog import ORACLE, QUERIES
from tidemark.plans.oracle_check import compare, duck

from .conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver test data absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, SF_SMALL, con)
    if key in ORACLE:
        assert r["status"] == "match", r
    else:
        assert r["status"] == "rows-only"


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())
