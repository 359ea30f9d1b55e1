"""Trip cleaning: one filter chain that Catalyst merges and pushes into the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.config import JobParams


def distinct_endpoints() -> Column:
    """Start and end differ (latitude or longitude)."""
    return (F.col("start_latitude") != F.col("end_latitude")) | (F.col("start_longitude") != F.col("end_longitude"))


def positive_duration() -> Column:
    """The trip ends after it starts."""
    return F.col("end_time") > F.col("start_time")


def inside_box(p: JobParams = JobParams()) -> Column:
    """Both ends inside the bounding box, bounds included.

    Null or NaN coordinates fail ``between`` (NaN sorts above every number in
    Spark), so such rows are dropped.
    """
    return (
        F.col("start_latitude").between(p.lat_south, p.lat_north)
        & F.col("end_latitude").between(p.lat_south, p.lat_north)
        & F.col("start_longitude").between(p.lon_west, p.lon_east)
        & F.col("end_longitude").between(p.lon_west, p.lon_east)
    )


def clean_trips(trips: DataFrame, p: JobParams = JobParams()) -> DataFrame:
    """Keep trips with distinct endpoints, a positive duration and both ends in the box.

    The bounds become ``PushedFilters`` of a Parquet scan; the column-to-column
    tests stay in the ``Filter`` right above it.  Idempotent.
    """
    return trips.filter(distinct_endpoints() & positive_duration() & inside_box(p))


def drop_nulls(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.dropna(how="any", subset=cols)
