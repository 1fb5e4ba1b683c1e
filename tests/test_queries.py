"""Every registered query against its DuckDB oracle (sf0.001), plus the entry."""

import pytest

import __spark_entry__ as entry_mod
from curbline.plans.queries import ORACLES, QUERIES
from conftest import SF_SMALL
from oracle_compare import compare, duckdb_connection

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_registry_complete():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLES) <= set(entry_mod.oracle_sql())
    assert len(NAMES) >= 41


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert r["cols_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["rows"][0] == r["rows"][1]
    assert r["hash_match"]


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["segment_id", "count_1995", "count_1996", "count_1997", "count_1998", "count_1999", "slope"]
    assert df.count() > 0
