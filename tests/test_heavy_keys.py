"""Joins with heavy keys, and the Bloom filter before a merge join."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from quarry.operators import broadcast_join, repartition_join
from quarry.operators.prefilter import bloom_words, filter_bits, filtered_join, may_match, prefiltered
from quarry.operators.skew import heavy_key_join, heavy_keys


def _pairs(spark, n=12000):
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 13 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("k"), F.col("id") % 997)).alias("k"), F.col("id").cast("string").alias("v"))
    right = spark.range(1500).select(F.when(F.col("id") < 2, F.lit("hot")).when(F.col("id") % 2 == 0, F.lit("warm")).otherwise(
        F.concat(F.lit("k"), F.col("id") % 997)).alias("k"), F.col("id").cast("string").alias("v"))
    return left, right


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_heavy_keys_of_a_side(spark):
    left, right = _pairs(spark)
    assert heavy_keys(left)[0] == "hot" and "warm" in heavy_keys(right)
    assert heavy_keys(spark.range(100_000).select(F.col("id").alias("k"))) == []
    assert heavy_keys(left.limit(0)) == []


def test_rows_equal_the_repartition_join_and_heavy_key_spans_tasks(spark):
    left, right = _pairs(spark)
    left = left.unionByName(spark.createDataFrame([("warm", "w")], "k string, v string"))
    l, r = left.withColumnRenamed("v", "lv"), right.withColumnRenamed("v", "rv")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        joined = heavy_key_join(l, r)
        assert _same(joined.select("k", "lv", "rv"), repartition_join(left, right))
        parts = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) >= 8 and max(p["count"] for p in parts) < sum(p["count"] for p in parts) / 4
        # columns of one name on both sides stay apart by position
        assert heavy_key_join(left, right).columns == ["k", "v", "v"]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_bucketed_tables_keep_their_layout_for_other_keys(spark):
    left, right = _pairs(spark)
    for name, df in (("heavy_l", left), ("heavy_r", right)):
        df.write.mode("overwrite").bucketBy(4, "k").sortBy("k").saveAsTable(name)
    try:
        l, r = spark.table("heavy_l").withColumnRenamed("v", "lv"), spark.table("heavy_r").withColumnRenamed("v", "rv")
        joined = heavy_key_join(l, r)
        assert _same(joined.select("k", "lv", "rv"), repartition_join(left, right))
        # exchanges of the two salted paths only
        assert plan_text(joined).count("Exchange hashpartitioning") <= 4 * 1
    finally:
        spark.sql("DROP TABLE heavy_l")
        spark.sql("DROP TABLE heavy_r")


@pytest.mark.parametrize("how", ["inner", "left_semi", "right"])
def test_filtered_join_has_the_rows_of_a_plain_join(spark, how):
    left, right = _pairs(spark)
    l, r = left.withColumnRenamed("v", "lv"), right.withColumnRenamed("v", "rv")
    assert _same(filtered_join(l, r, how=how), l.join(r.hint("merge"), "k", how))
    assert _same(filtered_join(l, r.limit(0), how=how), l.join(r.limit(0), "k", how))
    with pytest.raises(ValueError):
        filtered_join(l, r, how="left")


def test_filter_drops_rows_without_a_partner(spark):
    left = spark.range(200_000).select(F.col("id").alias("k"))
    right = spark.range(0, 200_000, 50).select(F.col("id").alias("k"))
    stay = prefiltered(left, right).count()
    assert 4000 <= stay <= 4000 + 0.02 * 196_000
    bits = 1 << 12  # a full filter lets everything through
    assert left.where(may_match(F.col("k"), bloom_words(right.unionByName(left), "k", bits), bits)).count() == 200_000
    assert filter_bits(0) == 1 << 12 and filter_bits(10 ** 12) == 1 << 27


def test_broadcast_join_beyond_the_bound_filters_and_merges(spark):
    left, right = _pairs(spark)
    joined = broadcast_join(left, right, max_rows=10)
    plan = plan_text(joined)
    assert "SortMergeJoin" in plan and "bit_get" in plan and "BroadcastHashJoin" not in plan.split("Subqueries")[0]
    assert _same(joined, repartition_join(left, right))
