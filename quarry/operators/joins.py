"""Joins with a strategy chosen by the caller.

Strategies are expressed as join hints on the DataFrame, never as session
settings (``autoBroadcastJoinThreshold``), so one query's choice does not leak
into the next and AQE still re-plans everything that is not hinted.

* ``auto``         -- no hint: the planner broadcasts a side whose estimated
                      size is under the threshold, AQE re-checks with run-time
                      sizes and handles skewed partitions of a sort-merge join.
* ``broadcast``    -- broadcast the right side, but only after a bounded check
                      proves its size (or the caller declares it bounded by
                      construction, e.g. a literal list); beyond the bound it
                      falls back to ``merge``.
* ``merge``        -- sort-merge join: both sides hash-partitioned on the key
                      (the repartition join).
* ``shuffle_hash`` -- both sides hash-partitioned, the right side hashed per
                      partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from quarry.operators.prefilter import filtered_join

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")

# Default bound for a broadcast side: rows and estimated bytes.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


_FIXED_WIDTH = {
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
    "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


def _width(dtype) -> int:
    name = dtype.simpleString()
    if name.startswith("decimal"):
        return 16
    return _FIXED_WIDTH.get(name, 32)


def _row_bytes(df: DataFrame) -> Column:
    """Estimated in-memory size of a row: actual length of strings, fixed width otherwise."""
    parts = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)).cast("long") + F.lit(8))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            # nested values: their JSON text length is a fair upper estimate
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("long") + F.lit(16))
        else:
            parts.append(F.lit(_width(field.dataType) + 8))
    if not parts:
        return F.lit(8)
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


# A side whose planner estimate is beyond so many times the bound is not looked at.
_ESTIMATE_SLACK = 8


def _planner_bytes(df: DataFrame) -> int | None:
    """The planner's size estimate of ``df``; None where it cannot be read (Spark Connect)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Prove that ``df`` is small enough to broadcast.

    A side whose estimated size is far beyond the bound is rejected without a
    job.  Otherwise one aggregate counts its rows and sums their bytes: every
    task sends one row, and one row reaches the driver.  The check runs
    ``df``'s plan; when that is costly, write or persist ``df`` first.
    """
    estimate = _planner_bytes(df)
    if estimate is not None and estimate > _ESTIMATE_SLACK * max_bytes:
        return False
    n, size = _rows_and_bytes(df)
    return n <= max_rows and size <= max_bytes


def _rows_and_bytes(df: DataFrame) -> tuple[int, int]:
    return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first())


def hinted(right: DataFrame, strategy: str, max_rows: int = BROADCAST_MAX_ROWS,
           max_bytes: int = BROADCAST_MAX_BYTES, bounded: bool = False) -> DataFrame:
    """The right side with the hint for ``strategy`` (checked for ``broadcast``).

    ``bounded=True`` states that the side is small by construction (a literal
    list, a ``limit``): it is then broadcast without running the check.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; expected one of {STRATEGIES}")
    if strategy == "auto":
        return right
    if strategy == "broadcast":
        if bounded or fits_broadcast(right, max_rows, max_bytes):
            return F.broadcast(right)
        return right.hint("merge")
    return right.hint(strategy)


def join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column, how: str = "inner",
         strategy: str = "auto", **bounds) -> DataFrame:
    """``left.join(right, on, how)`` with the join strategy picked by the caller."""
    return left.join(hinted(right, strategy, **bounds), on, how)


def repartition_join(left: DataFrame, right: DataFrame, key: str = "k") -> DataFrame:
    """Repartition join: both sides shuffled on the key, then merged.

    Output ``k, lv, rv``: one row per pair of values sharing a key (a key on one
    side only gives no row; duplicates multiply).  Rows of one key are never
    gathered into a list: the sort-merge join streams them, and AQE splits a
    skewed key's partition.
    """
    l = left.select(F.col(key).alias("k"), F.col("v").alias("lv"))
    r = right.select(F.col(key).alias("k"), F.col("v").alias("rv"))
    return l.join(r.hint("merge"), "k").select("k", "lv", "rv")


def broadcast_join(left: DataFrame, right: DataFrame, key: str = "k", max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES, bounded: bool = False) -> DataFrame:
    """Map-side join: the right side is broadcast (after a size check) and the left streams.

    Output ``k, lv, rv`` as in :func:`repartition_join`. Beyond the bound the join is a sort-merge join, and a Bloom
    filter of the right keys, sized by the checked count, drops left rows without a partner before their shuffle.
    """
    l = left.select(F.col(key).alias("k"), F.col("v").alias("lv"))
    r = right.select(F.col(key).alias("k"), F.col("v").alias("rv"))
    if bounded:
        return l.join(F.broadcast(r), "k").select("k", "lv", "rv")
    n, size = _rows_and_bytes(r)
    if n <= max_rows and size <= max_bytes:
        return l.join(F.broadcast(r), "k").select("k", "lv", "rv")
    return filtered_join(l, r, "k", rows=n).select("k", "lv", "rv")


def tagged_union(left: DataFrame, right: DataFrame, key: str = "k", left_tag: int = 0, right_tag: int = 1) -> DataFrame:
    """Union all of both sides, each row tagged with the side it came from: ``k, v, tag``."""
    l = left.select(F.col(key).alias("k"), F.col("v"), F.lit(left_tag).alias("tag"))
    r = right.select(F.col(key).alias("k"), F.col("v"), F.lit(right_tag).alias("tag"))
    return l.unionByName(r)


def format_pairs(joined: DataFrame, sep: str = ", ") -> DataFrame:
    """Text lines ``k, lv, rv`` of a pair join (what the text sink writes); a null is an empty field."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("k", "lv", "rv")]
    return joined.select(F.concat(fields[0], F.lit(sep), fields[1], F.lit(sep), fields[2]).alias("value"))


def limited_side_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], n: int,
                      order_by: Sequence[str] | str) -> DataFrame:
    """Join ``left`` with the first ``n`` rows of ``right`` in a stated order.

    Ordering first makes the kept rows deterministic.  The limited side is
    broadcast when its rows and bytes are within the broadcast bounds (checked);
    otherwise the join is a sort-merge join.
    """
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    return left.join(hinted(right.orderBy(*cols).limit(n), "broadcast"), on)
