"""The trip questions: mean duration by start hour, dearest trip per vendor, fastest trips.

Each function takes the raw trip and vendor frames, cleans the trips and
returns a DataFrame.  The derived columns are computed before the join so the
shuffle on ``id`` carries only the columns the answer needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quarry.config import JobParams
from quarry.functions.geo import haversine_km
from quarry.functions.timefn import duration_min, duration_sec, speed_ieee, speed_kmh
from quarry.operators.cleaning import clean_trips
from quarry.operators.joins import hinted
from quarry.operators.state import advance, merge_sum_count, sum_count_state
from quarry.sources.publish import published
from quarry.operators.ordering import dense_row_number, desc_nan_last, top_k
from quarry.schemas import DISTANCE_KM, DURATION_MIN, DURATION_SEC, HOUR_START, SPEED_KMH


def with_duration(trips: DataFrame) -> DataFrame:
    """Add ``duration_sec`` and ``duration_min``."""
    return trips.withColumns({
        DURATION_SEC: duration_sec("start_time", "end_time"),
        DURATION_MIN: duration_min("start_time", "end_time"),
    })


def with_distance(trips: DataFrame, p: JobParams = JobParams()) -> DataFrame:
    """Add ``distance_km`` (great-circle)."""
    return trips.withColumn(DISTANCE_KM, haversine_km("start_longitude", "start_latitude", "end_longitude",
                                                       "end_latitude", p.earth_radius_km))


def with_speed(trips: DataFrame, p: JobParams = JobParams()) -> DataFrame:
    """Add ``distance_km``, ``duration_min`` and ``speed_kmh`` (one projection)."""
    dist = haversine_km("start_longitude", "start_latitude", "end_longitude", "end_latitude", p.earth_radius_km)
    minutes = duration_min("start_time", "end_time")
    return trips.withColumns({DISTANCE_KM: dist, DURATION_MIN: minutes, SPEED_KMH: speed_kmh(dist, minutes)})


def mean_duration_by_hour(trips: DataFrame, p: JobParams = JobParams(), as_decimal: bool = False) -> DataFrame:
    """Mean trip minutes per start hour (0..23), ordered by hour.

    24 groups: the partial aggregate leaves at most 24 rows per task before the
    shuffle, whatever the skew of the hours.  ``as_decimal`` gives the
    ``decimal(32,2)`` display type; otherwise a double.
    """
    mean = F.avg(duration_min("start_time", "end_time"))
    if as_decimal:
        mean = mean.cast(DecimalType(32, 2))
    return (
        clean_trips(trips, p)
        .groupBy(F.hour("start_time").alias(HOUR_START))
        .agg(mean.alias(DURATION_MIN))
        .orderBy(HOUR_START)
    )


def mean_duration_sum_count(trips: DataFrame, p: JobParams = JobParams()) -> DataFrame:
    """The same mean from an explicit ``(sum, count)`` pair per hour."""
    return (
        clean_trips(trips, p)
        .groupBy(F.hour("start_time").alias(HOUR_START))
        .agg(F.sum(duration_sec("start_time", "end_time")).alias("sum_sec"), F.count(F.lit(1)).alias("n"))
        .withColumn(DURATION_MIN, F.col("sum_sec") / F.col("n") / F.lit(60.0))
        .orderBy(HOUR_START)
    )


def trips_with_vendor(trips: DataFrame, vendors: DataFrame, p: JobParams = JobParams(),
                      strategy: str = "auto") -> DataFrame:
    """Cleaned trips joined with their vendor on ``id`` (duplicate ids multiply)."""
    return clean_trips(trips, p).join(hinted(vendors, strategy), "id")


def max_cost_by_vendor(trips: DataFrame, vendors: DataFrame, p: JobParams = JobParams(),
                       strategy: str = "auto") -> DataFrame:
    """Dearest trip per vendor, ordered by vendor.

    Only ``id, cost`` of the trips reach the join; the max is aggregated
    partially before the vendor shuffle, so a vendor holding most trips is no
    hot spot.
    """
    t = clean_trips(trips, p).select("id", "cost")
    return (
        t.join(hinted(vendors.select("id", "vendor"), strategy), "id")
        .groupBy("vendor")
        .agg(F.max("cost").cast("double").alias("max_cost"))
        .orderBy("vendor")
    )


def _speeds(trips: DataFrame, p: JobParams, speed, extra=()) -> DataFrame:
    t = trips.filter(F.dayofmonth("start_time") > p.fastest_after_day)
    dist = haversine_km("start_longitude", "start_latitude", "end_longitude", "end_latitude", p.earth_radius_km)
    minutes = duration_min("start_time", "end_time")
    t = t.withColumns({DISTANCE_KM: dist, DURATION_MIN: minutes, SPEED_KMH: speed(dist, minutes),
                       DURATION_SEC: duration_sec("start_time", "end_time")})
    return t.select("id", "start_time", SPEED_KMH, *extra)


def fastest_trips(trips: DataFrame, vendors: DataFrame, p: JobParams = JobParams(), strategy: str = "auto",
                  details: bool = False) -> DataFrame:
    """The ``fastest_k`` fastest cleaned trips that start after day ``fastest_after_day`` of a month.

    Output ``id, start_time, vendor, speed_kmh`` (with ``details`` also
    ``distance_km`` and ``duration_sec``), fastest first, ties by id.
    Cleaning, the day filter and the speed are evaluated on the trip side
    before the join; the join output feeds a ``TakeOrderedAndProject``.
    """
    extra = [DISTANCE_KM, DURATION_SEC] if details else []
    t = _speeds(clean_trips(trips, p), p, speed_kmh, extra)
    joined = t.join(hinted(vendors.select("id", "vendor"), strategy), "id")
    return top_k(joined, p.fastest_k, [F.col(SPEED_KMH).desc(), F.col("id")]).select(
        "id", "start_time", "vendor", SPEED_KMH, *extra)


def speed_ranking(trips: DataFrame, vendors: DataFrame, p: JobParams = JobParams(), strategy: str = "auto",
                  top: int | None = None) -> DataFrame:
    """All uncleaned trips after day ``fastest_after_day`` with their vendor and ``rank``, fastest first:
    infinite speeds (no duration), finite ones, then NaN (no duration, no distance) and null; ties by id.

    The ranks are distributed (:func:`dense_row_number`); ids must be unique. ``top`` keeps the first ranks.
    """
    joined = _speeds(trips, p, speed_ieee).join(hinted(vendors.select("id", "vendor"), strategy), "id")
    joined = joined.select("id", "start_time", "vendor", SPEED_KMH)
    order = [desc_nan_last(SPEED_KMH), F.coalesce(F.isnan(SPEED_KMH), F.lit(False)).desc(), F.col("id")]
    if top is not None:
        joined = top_k(joined, top, order)
    return dense_row_number(joined, order, "rank")


def advance_durations(spark: SparkSession, base: str, new_trips: DataFrame, p: JobParams = JobParams()) -> int:
    """Merge new trips into the published ``(sum, count)`` of seconds per start hour at ``base``; earlier trips are not
    read again. Each trip must be merged once: a step that failed may be repeated, one that succeeded may not."""
    seconds = clean_trips(new_trips, p).select(F.hour("start_time").alias(HOUR_START), duration_sec("start_time", "end_time").alias("sec"))
    return advance(spark, base, sum_count_state(seconds, HOUR_START, "sec"), lambda a, b: merge_sum_count(a, b, HOUR_START))


def mean_duration_from_state(spark: SparkSession, base: str) -> DataFrame:
    """:func:`mean_duration_sum_count` from the published state."""
    state = published(spark, base)
    return state.select(HOUR_START, F.col("sum").alias("sum_sec"), "n", (F.col("sum") / F.col("n") / F.lit(60.0)).alias(DURATION_MIN)).orderBy(HOUR_START)
