"""Property checks on generated rows: cleaning idempotent, distance symmetric and bounded."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry import schemas
from quarry.functions.geo import haversine_km
from quarry.operators import clean_trips

import datetime as dt

coord = st.one_of(st.none(), st.just(float("nan")), st.floats(min_value=-82, max_value=48, allow_nan=False),
                  st.sampled_from([-80.0, -70.0, 40.0, 46.0]))
times = st.datetimes(min_value=dt.datetime(2015, 1, 1), max_value=dt.datetime(2015, 1, 3))
trip = st.tuples(st.integers(0, 10**6).map(str), times, times, coord, coord, coord, coord,
                 st.floats(0, 100, allow_nan=False, width=32))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trip, min_size=1, max_size=40))
def test_cleaning_idempotent_and_inside(spark, rows):
    df = spark.createDataFrame(rows, schemas.TRIPS)
    once = clean_trips(df)
    assert sorted(once.collect()) == sorted(clean_trips(once).collect())
    for r in once.collect():
        assert -80 <= r.start_longitude <= -70 and 40 <= r.end_latitude <= 46 and r.end_time > r.start_time


lonlat = st.tuples(st.floats(-180, 180, allow_nan=False), st.floats(-90, 90, allow_nan=False))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(lonlat, lonlat), min_size=1, max_size=30))
def test_distance_symmetric_and_bounded(spark, pairs):
    rows = [(a[0], a[1], b[0], b[1]) for a, b in pairs]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = df.select(haversine_km("a", "b", "c", "d").alias("x"), haversine_km("c", "d", "a", "b").alias("y"))
    for r in out.collect():
        assert 0 <= r.x <= 6371 * math.pi + 1e-6
        assert math.isclose(r.x, r.y, rel_tol=1e-9, abs_tol=1e-9)
