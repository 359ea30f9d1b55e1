"""Geographic column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.config import EARTH_RADIUS_KM


def haversine_sql(lon_start: str, lat_start: str, lon_end: str, lat_end: str,
                  radius_km: float = EARTH_RADIUS_KM) -> str:
    """The great-circle distance as SQL text over four column names (degrees in, km out)."""
    a = (f"least(pow(sin(radians({lat_end} - {lat_start}) / 2), 2) + cos(radians({lat_start})) * "
         f"cos(radians({lat_end})) * pow(sin(radians({lon_end} - {lon_start}) / 2), 2), 1D)")
    return f"({float(radius_km)!r}D * (2D * atan2(sqrt({a}), sqrt(1D - {a}))))"


def haversine_km(
    lon_start: Column | str,
    lat_start: Column | str,
    lon_end: Column | str,
    lat_end: Column | str,
    radius_km: float = EARTH_RADIUS_KM,
) -> Column:
    """Great-circle distance in km between two (longitude, latitude) points in degrees.

    A plain column expression (no UDF), so it is code-generated and Catalyst
    can evaluate filters before it.  ``a`` is clamped to 1: for antipodal points
    rounding can push it above 1, which would make ``sqrt(1 - a)`` NaN.
    Column names are turned into one SQL expression (built in a single call);
    Column arguments are combined with the Column API.
    """
    args = (lon_start, lat_start, lon_end, lat_end)
    if all(isinstance(x, str) for x in args):
        return F.expr(haversine_sql(*(f"`{x}`" for x in args), radius_km=radius_km))
    lon1, lat1, lon2, lat2 = (F.col(x) if isinstance(x, str) else x for x in args)
    a = (F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2))
    a = F.least(a, F.lit(1.0))
    return F.lit(float(radius_km)) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))
