"""Declared schemas of the job inputs (no schema inference by default)."""

from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Column names of the derived trip quantities.  The original jobs used names
# with spaces and brackets ("distance (km)"); these need no quoting in SQL.
HOUR_START = "hour_start"
DISTANCE_KM = "distance_km"
DURATION_MIN = "duration_min"
DURATION_SEC = "duration_sec"
SPEED_KMH = "speed_kmh"

TRIPS = StructType(
    [
        StructField("id", StringType()),
        # Local date-times without a zone: durations never depend on the
        # session time zone or daylight-saving changes.
        StructField("start_time", TimestampNTZType()),
        StructField("end_time", TimestampNTZType()),
        StructField("start_longitude", DoubleType()),
        StructField("start_latitude", DoubleType()),
        StructField("end_longitude", DoubleType()),
        StructField("end_latitude", DoubleType()),
        StructField("cost", FloatType()),
    ]
)

VENDORS = StructType([StructField("id", StringType()), StructField("vendor", StringType())])

SEARCHES = StructType(
    [
        StructField("userid", StringType()),
        StructField("keywords", StringType()),
        StructField("date", TimestampNTZType()),
        # null when the search led to no click
        StructField("pos", IntegerType()),
        StructField("url", StringType()),
    ]
)

TITLES = StructType([StructField("title", StringType())])

STOP_WORDS = StructType([StructField("stopWords", StringType())])

PAIRS = StructType([StructField("k", StringType()), StructField("v", StringType())])

CORRUPT_COLUMN = "_corrupt_record"


def with_corrupt_column(schema: StructType) -> StructType:
    """Schema plus the string column that receives malformed lines."""
    return StructType(list(schema.fields) + [StructField(CORRUPT_COLUMN, StringType())])
