"""Joins that survive heavy keys without run-time re-planning (bucketed tables, AQE off, sorted inputs).

A heavy-hitter summary names the keys that hold a large share of either side: each task keeps a bounded list of counters,
lists are merged, and one row reaches the driver. Rows of those keys take their own path, spread over salted
parts; all other rows are merged as usual, and on bucketed tables without an exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_HEAVY = 256
TRACKED = 8192
# A key is heavy from this share of a side's rows on: more than half of a task's part in 128 tasks.
HEAVY_SHARE = 1 / 256
SALTS = 32


def heavy_keys(df: DataFrame, key: str = "k", share: float = HEAVY_SHARE, most: int = MOST_HEAVY, tracked: int = TRACKED) -> list:
    """Keys that may hold at least ``share`` of the rows, most frequent first.

    Every key above the share is among them (a summary of ``tracked`` counters errs by about 3.5 / ``tracked`` of the rows, which is added),
    and at most ``most`` keys come to the driver. Null is none: it joins nothing.
    """
    if share * most < 1 or tracked * share < 8:
        raise ValueError("too few keys or counters for this share")
    rows = df.where(F.col(key).isNotNull())
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] >= (share - 3.5 / tracked) * found["n"]]


def _salt(df: DataFrame, salts: int) -> Column:
    """A part number from the whole row, the same in every attempt."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")


def heavy_key_join(left: DataFrame, right: DataFrame, key: str = "k", salts: int = SALTS, share: float = HEAVY_SHARE) -> DataFrame:
    """Inner equi-join with the rows of heavy keys spread over ``salts`` parts.

    Heavy keys of the left side: its rows are salted and the right side's rows of these keys are repeated for each salt; of the
    right side (and not the left): the other way round. Rows of all other keys go through a sort-merge join. The three row sets are disjoint
    by key, so the result has the rows of a plain join. Heavy on both sides means a product of that size by definition; it is
    then spread as well. Rows equal in every column share a salt.
    """
    of_left = heavy_keys(left, key, share)
    of_right = [k for k in heavy_keys(right, key, share) if k not in set(of_left)]
    heavy = of_left + of_right
    if not heavy:
        return left.join(right.hint("merge"), key)
    # the key first on both sides, as in a join by name
    left = left.select(key, *[c for c in left.columns if c != key])
    right = right.select(key, *[c for c in right.columns if c != key])

    def salted(many: DataFrame, few: DataFrame, keys: list) -> tuple[DataFrame, DataFrame, str]:
        part = "salt"
        while part in many.columns or part in few.columns:
            part += "_"
        some, other = many.where(F.col(key).isin(keys)), few.where(F.col(key).isin(keys))
        return some.withColumn(part, _salt(some, salts)), other.withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), part

    light = ~F.coalesce(F.col(key).isin(heavy), F.lit(False))
    out = left.where(light).join(right.where(light).hint("merge"), key)
    if of_left:
        many, few, part = salted(left, right, of_left)
        out = out.union(many.join(few.hint("merge"), [key, part]).drop(part))  # by position: sides may share names
    if of_right:
        many, few, part = salted(right, left, of_right)
        out = out.union(few.join(many.hint("merge"), [key, part]).drop(part))
    return out
