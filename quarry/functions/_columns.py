"""Shared helper: accept a column name or a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
