"""The expressions of this package as SQL functions.

``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` defines SQL UDFs, which
Catalyst inlines into plain expressions: they stay code-generated and keep
filter pushdown, unlike JVM or Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from quarry.config import EARTH_RADIUS_KM
from quarry.functions.geo import haversine_sql
from quarry.functions.text import NUMBER_CLASS, PRINTABLE_MAX, PRINTABLE_MIN, SYMBOL_CLASS

_DEFINITIONS = {
    "haversine": f"""
        (lon_start DOUBLE, lat_start DOUBLE, lon_end DOUBLE, lat_end DOUBLE) RETURNS DOUBLE
        RETURN {haversine_sql("lon_start", "lat_start", "lon_end", "lat_end", EARTH_RADIUS_KM)}
    """,
    "is_printable_word": f"""
        (word STRING) RETURNS BOOLEAN
        RETURN coalesce(ascii(word) BETWEEN {PRINTABLE_MIN} AND {PRINTABLE_MAX}, false)
    """,
    "first_letter_class": f"""
        (word STRING) RETURNS STRING
        RETURN CASE WHEN ascii(word) BETWEEN 65 AND 90 OR ascii(word) BETWEEN 97 AND 122
                    THEN upper(substring(word, 1, 1))
                    WHEN ascii(word) BETWEEN 48 AND 57 THEN '{NUMBER_CLASS}'
                    ELSE '{SYMBOL_CLASS}' END
    """,
    "speed_kmh": """
        (distance_km DOUBLE, minutes DOUBLE) RETURNS DOUBLE
        RETURN try_divide(distance_km, minutes / 60D)
    """,
    "duration_min": """
        (start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ) RETURNS DOUBLE
        RETURN timestampdiff(SECOND, start_time, end_time) / 60D
    """,
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the SQL functions in the session; returns their names."""
    for name, body in _DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(_DEFINITIONS)
