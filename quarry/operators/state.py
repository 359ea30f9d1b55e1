"""Mergeable partial states: aggregates that new rows are merged into, without reading old rows again.

* mean: ``(sum, n)`` per key; states add up.
* distinct count: one bitmap per key and block of 32,768 dictionary ids; states are joined by OR. Ids come from a
  dictionary that only grows, so a bit means the same value in every state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.ranges import row_number_by_ranges


def sum_count_state(df: DataFrame, key: str, value: str) -> DataFrame:
    """State ``key, sum, n`` of the non-null values of each key."""
    return df.groupBy(key).agg(F.coalesce(F.sum(value), F.lit(0)).alias("sum"), F.count(value).alias("n"))


def merge_sum_count(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The state of both inputs' rows together."""
    return a.unionByName(b).groupBy(key).agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))


def grown_dictionary(known: DataFrame | None, values: DataFrame, value: str) -> DataFrame:
    """``value, id``: the known entries unchanged, and new ids from the next free one on for values not seen yet (in their order)."""
    seen = values.select(value).where(F.col(value).isNotNull()).distinct()
    if known is None:
        return row_number_by_ranges(seen, [value], "id").select(value, "id")
    new = row_number_by_ranges(seen.join(known.select(value), value, "left_anti"), [value], "id")
    last = known.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return known.select(value, "id").unionByName(new.select(value, (F.col("id") + last).alias("id")))


def distinct_state(df: DataFrame, key: str, value: str, dictionary: DataFrame) -> DataFrame:
    """State ``key, block, bits`` of the distinct values of each key: 4 KB for a block with any of its ids.

    Rows are folded to one per key and value by a partial aggregation before they meet the dictionary.
    """
    ids = df.where(F.col(value).isNotNull()).select(key, value).distinct().join(dictionary, value)
    return ids.groupBy(key, F.bitmap_bucket_number("id").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merge_distinct(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.unionByName(b).groupBy(key, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(state: DataFrame, key: str, name: str = "distinct") -> DataFrame:
    return state.groupBy(key).agg(F.sum(F.bitmap_count("bits")).alias(name))


def advance(spark: SparkSession, base: str, new_state: DataFrame, merge) -> int:
    """Merge a state of new rows into the published state at ``base`` and publish the result; returns its version.

    Only the published state and the new rows are read. A failure leaves the state before it in place; a second
    writer of the same step fails instead of losing rows.
    """
    from quarry.sources.publish import current_version, publish, published

    version = current_version(spark, base)
    merged = merge(published(spark, base, version), new_state) if version else new_state
    return publish(merged, base, expected=version)
