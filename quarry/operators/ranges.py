"""Fixed ranges: row numbers and paged groups from ranges that are a function of the row.

A range partitioning samples its bounds anew in every evaluation. Here the bounds (splitters) are
read once from a hash sample of the order keys and written into the plan, so the range of a row is a plain
expression of its order columns: counts and rows may be computed in different jobs, tasks may be repeated, and still agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows aimed at in one range, the most ranges (their splitters are literals of the plan), and the sampled keys per range.
RANGE_ROWS = 1_000_000
MOST_RANGES = 4096
SAMPLED_PER_RANGE = 32


def _spare(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def splitters(df: DataFrame, order: Sequence[str], ranges: int) -> list[tuple]:
    """At most ``ranges - 1`` ascending order keys that cut ``df`` into ranges of about equal size.

    Keys are sampled by their hash, so the sample does not depend on partitions or attempts; about
    ``SAMPLED_PER_RANGE * ranges`` distinct keys come to the driver.
    """
    total = df.count()
    wanted = SAMPLED_PER_RANGE * ranges
    keys = df.select(*order)
    if total > 2 * wanted:
        keys = keys.where(F.pmod(F.xxhash64(*order), F.lit(total // wanted)) == 0)
    # sorted by Spark, so that its order of types and nulls decides
    sample = [tuple(r) for r in keys.distinct().orderBy(*order).collect()]
    cuts = [sample[len(sample) * k // ranges] for k in range(1, ranges)] if sample else []
    return list(dict.fromkeys(cuts))


def range_id(df: DataFrame, order: Sequence[str], cuts: list[tuple]) -> Column:
    """How many of the ascending ``cuts`` are at or below the row's order columns: a binary search over literals."""
    if not cuts:
        return F.lit(0)
    types = [df.schema[c].dataType for c in order]
    literals = F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"c{k}") for k, (v, t) in enumerate(zip(cut, types))]) for cut in cuts])
    row = F.struct(*[F.col(c).cast(t).alias(f"c{k}") for k, (c, t) in enumerate(zip(order, types))])
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        # a step beyond the cuts is not taken: get() gives null there
        lambda at, step: F.when(F.get(literals, at + step - 1).isNotNull() & (F.get(literals, at + step - 1) <= row), at + step).otherwise(at))


def ranges_for(df: DataFrame, range_rows: int = RANGE_ROWS) -> int:
    """A number of ranges with about ``range_rows`` rows each, 8 to MOST_RANGES."""
    return max(8, min(MOST_RANGES, df.count() // range_rows))


def row_number_by_ranges(df: DataFrame, order: Sequence[str], name: str = "row_num", ranges: int | None = None) -> DataFrame:
    """1-based row numbers in ascending order of the columns ``order`` (nulls first), which should be unique.

    Rows are numbered within their range and shifted by the counts of the ranges before it. Nothing is copied or
    checkpointed: the counts (one row per range) are a second, shuffle-free reading of the order columns.
    """
    cuts = splitters(df, order, ranges or ranges_for(df))
    part, offset = _spare(df, "range"), _spare(df, "before")
    placed = df.withColumn(part, range_id(df, order, cuts))
    # one row per range: bounded, so it may be summed up in one task and broadcast
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(part, F.coalesce(F.sum("n").over(
        Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(offset))
    inner = F.row_number().over(Window.partitionBy(part).orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    return placed.withColumn(name, inner.cast("long")).join(F.broadcast(before), part).withColumn(
        name, F.col(name) + F.col(offset)).drop(part, offset)


def grouped_values(df: DataFrame, key: str, value: str, order: Sequence[str] = (), page_size: int = 1000, ranges: int | None = None) -> DataFrame:
    """All values of each key, in pages: ``key, page, n, values``.

    Pages are numbered from 0, hold ``page_size`` values (the last one fewer) in the order of ``(value, *order)``,
    nulls first and kept. A key's list may have any length: its rows lie in as many ranges as their number asks for, positions come from
    the counts of (key, range), and only the rows of one page meet in a task. Rows that agree in key, value and
    ``order`` share a range; name a unique column in ``order`` if they may be many. A null key is a key.
    """
    columns = list(dict.fromkeys([key, value, *order]))
    rows = df.select(*columns)
    cuts = splitters(rows, columns, ranges or ranges_for(rows))
    part, first, page, n, place = (_spare(rows, c) for c in ("range", "before", "page", "n", "place"))
    placed = rows.withColumn(part, range_id(rows, columns, cuts))
    # pairs of key and range: at most the distinct keys and the ranges together
    counts = placed.groupBy(key, part).agg(F.count(F.lit(1)).alias(n))
    before = counts.select(F.col(key).alias("_k"), F.col(part).alias("_r"), F.coalesce(F.sum(n).over(
        Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(first))
    sorted_by = [F.col(c).asc_nulls_first() for c in columns[1:]]
    inner = placed.withColumn(place, F.row_number().over(Window.partitionBy(key, part).orderBy(*sorted_by)) - 1)
    at = inner.join(before, inner[key].eqNullSafe(F.col("_k")) & (inner[part] == F.col("_r"))).withColumn(place, F.col(place) + F.col(first))
    pages = at.withColumn(page, F.floor(F.col(place) / page_size)).groupBy(key, page).agg(
        F.count(F.lit(1)).alias(n), F.array_sort(F.collect_list(F.struct(F.col(place), F.col(value).alias("v")))).alias("values"))
    return pages.select(F.col(key), F.col(page).alias("page"), F.col(n).alias("n"), F.transform("values", lambda x: x["v"]).alias("values"))
