"""Answers do not depend on session settings the caller owns: ANSI mode, time
zone, automatic broadcast, shuffle partition count."""

import pytest

from oracle_check import compare, duck
from quarry.plans.catalog import QUERIES
from quarry.plans.oracle import SQL

OTHER = {
    "spark.sql.ansi.enabled": "false",
    "spark.sql.session.timeZone": "Asia/Kolkata",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "200",
}


@pytest.fixture(scope="module")
def other_settings(spark):
    old = {k: spark.conf.get(k) for k in OTHER}
    for k, v in OTHER.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle_under_other_settings(spark, other_settings, con, sf_small, key):
    ok, msg = compare(spark, con, key, QUERIES[key], SQL[key], sf_small)
    assert ok, msg
