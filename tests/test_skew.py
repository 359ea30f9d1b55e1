"""Hot keys: one key holding a third of the rows.

AQE's skew handling is forced with low thresholds so the tiny test data
behaves like a skewed partition of a large job.
"""

import pytest
from pyspark.sql import functions as F

from quarry.operators import plan_string

from conftest import plan_text
from quarry.operators import repartition_join
from quarry.plans import searchlog, trips

SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed_pairs(spark, n=30000):
    # key "hot" holds a third of the left rows
    left = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
        .alias("k"), F.col("id").cast("string").alias("v"))
    right = spark.range(2000).select(
        F.when(F.col("id") < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
        .alias("k"), F.col("id").cast("string").alias("v"))
    return left, right


def test_repartition_join_splits_hot_partition(spark, skew_conf):
    left, right = _skewed_pairs(spark)
    j = repartition_join(left, right)
    n = j.count()
    # expected size from per-key counts (exact, independent of the plan)
    lc = left.groupBy("k").count().withColumnRenamed("count", "a")
    rc = right.groupBy("k").count().withColumnRenamed("count", "b")
    want = lc.join(rc, "k").select(F.sum(F.col("a") * F.col("b"))).first()[0]
    assert n == want
    j.collect()
    final = plan_string(j, "simple")
    assert "skew=true" in final


def test_hot_keyword_is_pre_aggregated(spark):
    rows = [("the the the x",), ("the y",), ("z",)] * 100
    s = spark.createDataFrame(rows, "keywords string")
    out = searchlog.keyword_counts(s, top=None)
    plan = plan_text(out)
    assert "partial_count" in plan
    assert {r.keyword: r.appearances for r in out.collect()}["the"] == 400


def test_hot_url_distinct_is_spread_by_user(spark):
    rows = [(str(u), 1, "http://hot/") for u in range(300)] + [(str(u), 1, f"http://u{u % 7}/") for u in range(100)]
    s = spark.createDataFrame(rows, "userid string, pos int, url string")
    out = searchlog.popular_urls(s)
    plan = plan_text(out)
    # first aggregation keyed by (url, userid): a hot url is split by user before its final count
    assert "hashpartitioning(url#" in plan and "userid#" in plan.split("hashpartitioning(url#")[1].split(")")[0]
    assert out.first().url == "http://hot/" and out.first().distinct_visitors == 300


def test_vendor_max_is_pre_aggregated(spark, sf_small):
    from quarry import fixtures as fx

    plan = plan_text(trips.max_cost_by_vendor(fx.trips(spark, sf_small), fx.vendors(spark, sf_small)))
    assert "partial_max" in plan
