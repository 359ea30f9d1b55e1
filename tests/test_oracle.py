"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from quarry.plans.catalog import QUERIES
from quarry.plans.oracle import SQL

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, sf_small, key):
    ok, msg = compare(spark, con, key, QUERIES[key], SQL[key], sf_small)
    assert ok, msg


def test_every_key_has_an_oracle():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["id", "start_time", "vendor", "speed_kmh"]
    assert len(rows) == 5
