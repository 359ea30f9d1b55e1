"""Cleaning, joins with a strategy, ordering (19-23, 38-53)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_text
from quarry import fixtures as fx
from quarry import schemas
from quarry.config import scratch_dir
from quarry.operators import (
    broadcast_join,
    clean_trips,
    dense_row_number,
    desc_nan_last,
    fits_broadcast,
    format_pairs,
    join,
    limited_side_join,
    range_sorted,
    repartition_join,
    tagged_union,
    top_k,
)

T0 = dt.datetime(2024, 1, 1, 10, 0)
T1 = dt.datetime(2024, 1, 1, 10, 30)


def _trip(i, lon0, lat0, lon1, lat1, start=T0, end=T1):
    return (str(i), start, end, lon0, lat0, lon1, lat1, 1.0)


def test_cleaning_edges(spark):
    nan = float("nan")
    rows = [
        _trip(1, -80.0, 40.0, -70.0, 46.0),          # on the bounds: kept
        _trip(2, -80.0001, 40.0, -70.0, 46.0),       # just outside: dropped
        _trip(3, None, 40.0, -70.0, 46.0),           # null: dropped
        _trip(4, nan, 40.0, -70.0, 46.0),            # NaN: dropped
        _trip(5, -75.0, 42.0, -74.0, 42.0),          # same latitude, other longitude: kept
        _trip(6, -75.0, 42.0, -75.0, 42.0),          # same point: dropped
        _trip(7, -75.0, 42.0, -74.0, 43.0, T1, T0),  # reversed times: dropped
        _trip(8, -75.0, 42.0, -74.0, 43.0, T0, T0),  # zero duration: dropped
    ]
    df = spark.createDataFrame(rows, schemas.TRIPS)
    kept = sorted(r.id for r in clean_trips(df).collect())
    assert kept == ["1", "5"]


def test_cleaning_idempotent(spark, sf_small):
    t = fx.trips(spark, sf_small)
    once = clean_trips(t)
    assert once.count() == clean_trips(once).count() == 541


PAIRS_L = [("a", "l1"), ("a", "l2"), ("b", "l3"), ("c", "l4")]
PAIRS_R = [("a", "r1"), ("a", "r2"), ("a", "r3"), ("b", "r4"), ("d", "r5")]


def _pairs(spark):
    l = spark.createDataFrame(PAIRS_L, "k string, v string")
    r = spark.createDataFrame(PAIRS_R, "k string, v string")
    return l, r


def test_pair_joins_agree(spark):
    l, r = _pairs(spark)
    rep = sorted(repartition_join(l, r).collect())
    bc = sorted(broadcast_join(l, r).collect())
    assert rep == bc
    assert len(rep) == 2 * 3 + 1          # key a: 2 x 3, key b: 1, c and d: none
    lines = sorted(r.value for r in format_pairs(repartition_join(l, r)).collect())
    assert lines[0] == "a, l1, r1"
    odd = spark.createDataFrame([("", None, "r"), (None, "l", "")], "k string, lv string, rv string")
    assert sorted(r.value for r in format_pairs(odd).collect()) == [", , r", ", l, "]


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "merge", "shuffle_hash"])
def test_strategies_same_rows(spark, strategy):
    l, r = _pairs(spark)
    base = sorted(l.join(r.withColumnRenamed("v", "w"), "k").collect())
    got = sorted(join(l, r.withColumnRenamed("v", "w"), "k", strategy=strategy).collect())
    assert got == base


def test_strategy_plans(spark, sf_small):
    from quarry.operators import join_operators

    li = fx.table(spark, sf_small, "lineitem").select("l_orderkey")
    o = fx.table(spark, sf_small, "orders").select("o_orderkey")
    cond = li.l_orderkey == o.o_orderkey
    assert join_operators(join(li, o, cond, strategy="merge")) == ["SortMergeJoin Inner"]
    assert join_operators(join(li, o, cond, strategy="broadcast")) == ["BroadcastHashJoin Inner"]
    assert "BroadcastHashJoin" in plan_text(join(li, o, cond, strategy="broadcast"))
    assert "SortMergeJoin" in plan_text(join(li, o, cond, strategy="merge"))
    assert "ShuffledHashJoin" in plan_text(join(li, o, cond, strategy="shuffle_hash"))
    # beyond the bound the broadcast request falls back to a sort-merge join
    assert "SortMergeJoin" in plan_text(join(li, o, cond, strategy="broadcast", max_rows=100))


def test_fits_broadcast_bounds(spark, sf_small):
    o = fx.table(spark, sf_small, "orders")
    assert fits_broadcast(o, max_rows=1500)
    assert not fits_broadcast(o, max_rows=1499)
    assert not fits_broadcast(o, max_rows=10_000, max_bytes=1000)


def test_unknown_strategy(spark):
    l, r = _pairs(spark)
    with pytest.raises(ValueError):
        join(l, r, "k", strategy="nested_loop")


def test_tagged_union(spark):
    l, r = _pairs(spark)
    u = tagged_union(l, r)
    assert u.count() == len(PAIRS_L) + len(PAIRS_R)
    assert sorted(r.tag for r in u.groupBy("tag").count().collect()) == [0, 1]


def test_limited_side_join_is_broadcast_and_deterministic(spark, sf_small):
    t, v = fx.trips(spark, sf_small), fx.vendors(spark, sf_small)
    j = limited_side_join(t, v, "id", 100, "id")
    assert "BroadcastHashJoin" in plan_text(j)
    first_ids = sorted(r.id for r in v.orderBy("id").limit(100).collect())
    assert sorted(r.id for r in j.collect()) == first_ids


def test_top_k_plan_and_ties(spark):
    df = spark.createDataFrame([(str(i), float(i % 3)) for i in range(20)], "id string, s double")
    out = top_k(df, 5, [F.col("s").desc(), F.col("id")])
    assert "TakeOrderedAndProject" in plan_text(out)
    assert [r.id for r in out.collect()] == ["11", "14", "17", "2", "5"]


def test_nan_last(spark):
    rows = [("a", float("nan")), ("b", float("inf")), ("c", 1.0), ("d", None), ("e", 2.0)]
    df = spark.createDataFrame(rows, "id string, s double")
    got = [r.id for r in df.orderBy(desc_nan_last("s"), "id").collect()]
    assert got[:3] == ["b", "e", "c"]
    assert set(got[3:]) == {"a", "d"}


def test_dense_row_number_matches_global_window(spark, sf_small):
    s = fx.searches(spark, sf_small).select("event_id", "userid")
    got = dense_row_number(s, ["userid", "event_id"], "rn", num_partitions=7)
    want = s.withColumn("rn", F.row_number().over(Window.orderBy("userid", "event_id")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_range_sorted_spreads_a_hot_key(spark):
    # one key holds half the rows: the tie-break lets it span several partitions, order kept
    rows = [("hot" if i % 2 else f"k{i:04d}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "w string, i int")
    out = range_sorted(df, 8, ["w"], ["i"]).withColumn("p", F.spark_partition_id())
    hot_parts = out.filter(F.col("w") == "hot").select("p").distinct().count()
    assert hot_parts > 1
    per_part = out.groupBy("p").agg(F.min("w").alias("lo"), F.max("w").alias("hi")).orderBy("p").collect()
    for a, b in zip(per_part, per_part[1:]):
        assert a.hi <= b.lo


def test_fits_broadcast_counts_nested_values(spark):
    df = spark.range(100).select("id", F.array_repeat(F.lit("x" * 100), 50).alias("a"))
    assert fits_broadcast(df, max_rows=1000, max_bytes=10**6)
    assert not fits_broadcast(df, max_rows=1000, max_bytes=100 * 50 * 100)


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_dense_row_number_with_payload_columns(spark, aqe):
    # more rows in a partition than a range sample holds, and columns beyond the order key
    log = fx.search_log(spark, "/root/testdata/sf0.1")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        got = dense_row_number(log, ["userid", "event_id"], "rn")
        path = scratch_dir(spark, "numbered")
        got.write.parquet(path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    got = spark.read.parquet(path)
    want = log.withColumn("want", F.row_number().over(Window.orderBy("userid", "event_id")))
    assert got.columns == [*log.columns, "rn"]
    assert got.join(want, ["event_id", "userid"]).filter(F.col("rn") != F.col("want")).count() == 0
    assert got.select("rn").distinct().count() == log.count()


def test_fits_broadcast_bounds_of_a_table(spark):
    li = fx.table(spark, "/root/testdata/sf0.01", "lineitem").select("l_orderkey", "l_linenumber")
    assert fits_broadcast(li, max_rows=100_000)
    assert not fits_broadcast(li, max_rows=59_999)
    assert not fits_broadcast(li, max_rows=100_000, max_bytes=10_000)


def test_fits_broadcast_of_a_large_side_moves_one_row_per_task(spark):
    # far beyond the bound: settled by the planner's estimate, without a job
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("size-check", "size check")
    try:
        assert not fits_broadcast(spark.range(200_000_000).selectExpr("id", "id AS x"))
        assert len(tracker.getJobIdsForGroup("size-check")) == 0
        # near the bound: one aggregate, a row from each task
        assert not fits_broadcast(spark.range(20_000_000, numPartitions=4))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_limited_side_beyond_the_bytes_is_merged(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1_000_000).alias("v"))
    joined = limited_side_join(spark.range(100), wide, "id", 90, "id")
    assert "BroadcastHashJoin" not in plan_text(joined)
    assert joined.count() == 90
