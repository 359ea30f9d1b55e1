"""Answers do not depend on the session time zone; bench.py prints one JSON line."""

import json
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

ZONE_KEYS = ["fastest_trips", "trip_mean_duration_by_hour", "trip_duration", "searches_per_day",
             "searches_per_week", "parse_timestamps", "mean_sum_count"]


@pytest.mark.parametrize("key", ZONE_KEYS)
def test_same_answer_in_another_session_zone(spark, sf_small, key):
    fn = entry.queries()[key]
    utc = sorted(fn(spark, sf_small).collect())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        other = sorted(fn(spark, sf_small).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == other


def test_bench_prints_one_json_line(sf_small):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=sf_small, BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="trip_clean,searches_per_month")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"trip_clean", "searches_per_month"}
    assert rec["value"] == pytest.approx(sum(rec["queries"].values()), abs=0.01)
