"""Top-k, NaN-aware ordering, distributed dense row numbers, range-partitioned sort."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.config import checkpoint_dir


def _cols(cols: Sequence[Column | str] | Column | str) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k(df: DataFrame, k: int, order: Sequence[Column | str]) -> DataFrame:
    """First ``k`` rows in ``order``; planned as ``TakeOrderedAndProject``.

    Every partition keeps its own ``k`` best rows and only those meet in the
    final merge, so no full sort or single-partition exchange of the input.
    ``order`` should end with a unique column so ties are deterministic.
    """
    return df.orderBy(*_cols(order)).limit(k)


def desc_nan_last(c: Column | str) -> Column:
    """Descending order that puts NaN and null after every number.

    Spark (and SQL) sort NaN above +Infinity, so a plain ``desc`` would put NaN
    first; mapping NaN to null and sorting nulls last states the intent.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(col), col).desc_nulls_last()


def dense_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "row_num",
                     num_partitions: int | None = None) -> DataFrame:
    """1-based row numbers in a global order, without a single-partition window.

    ``row_number()`` over an unpartitioned window moves every row into one
    task.  Here the rows are range-partitioned on the order and each partition is
    sorted locally.  That frame is checkpointed once to the shared folder: the bounds
    of a range partitioning are sampled, so two evaluations may differ, and
    the counts must come from the very rows that are numbered.  A row's number is
    the count of rows in earlier partitions (a table with one row per partition)
    plus its position in its own.  ``order`` should be a unique key, so that
    ties do not depend on the input's order.
    """
    order_cols = _cols(order)
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = (
        df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
        .withColumn("_pid", F.spark_partition_id())
        # monotonically_increasing_id = (partition index << 33) + position in partition
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33))
        .checkpoint(eager=True)
    )
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
        # at most one row per partition: bounded, safe to order in one task and broadcast
        .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    return (
        numbered.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_off") + F.col("_pos") + F.lit(1))
        .drop("_pid", "_pos", "_off")
    )


def range_sorted(df: DataFrame, n: int | None, keys: Sequence[Column | str],
                 tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Partitions holding consecutive key ranges, each sorted: a globally sorted layout.

    ``n`` fixes the partition count; ``None`` lets AQE size the partitions from
    the data (advisory partition size), which suits large outputs.  Partition
    boundaries use ``keys`` plus ``tie_break`` so one very frequent key can
    span several partitions instead of filling one; rows stay in key order
    across partitions.
    """
    part_cols = _cols(keys) + _cols(tie_break)
    ranged = df.repartitionByRange(*part_cols) if n is None else df.repartitionByRange(n, *part_cols)
    return ranged.sortWithinPartitions(*part_cols)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Cache ``df`` for the actions inside the block and unpersist after the last one."""
    cached = df.persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()
