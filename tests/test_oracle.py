"""Every registered query against its DuckDB oracle on the smallest driver data."""

import pytest

from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck

import __spark_entry__ as entry_mod

QUERIES = entry_mod.queries()
ORACLES = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_callable():
    assert len(QUERIES) >= 60
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, QUERIES[key], ORACLES.get(key), SF_SMALL, verbose=True)
    assert res["ok"] in (True, None), res
    assert "type_mismatch" not in res, res


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0 and "segment" in df.columns
