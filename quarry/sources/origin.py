"""Where a malformed line stands: file and line number, from files that are still read in splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.schemas import CORRUPT_COLUMN, with_corrupt_column
from quarry.sources.readers import NO_VALUE, READ_TIME_FORMAT


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, at, value`` of every line: ``at`` grows along a split (file, first byte) by one per line."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def with_line_numbers(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """``rows`` (file, block, at, …) of ``lines`` with ``line``, the number from 1 in the file.

    A split's first line has the count of the lines in the file's splits before it; that table has one row per
    split, and a file's splits are summed up in one group.
    """
    splits = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return rows.join(starts, ["file", "block"]).withColumn("line", F.col("at") + F.col("shift")).drop("block", "at", "shift")


def read_with_origin(spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = False,
                     time_format: str = READ_TIME_FORMAT) -> tuple[DataFrame, DataFrame]:
    """Read delimited text into ``(good, rejected)``; ``rejected`` has ``file`` and ``line`` besides the columns that parse and
    the raw line (``_corrupt_record``).

    Lines are parsed as in ``read_with_rejects``; blank lines and, with ``header``, the first line of each
    file are no rows, but count as lines. Only the rejected lines meet the table of splits.
    """
    lines = numbered_lines(spark, path)
    options = {"sep": sep, "escape": '"', "nullValue": NO_VALUE, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN,
               "timestampNTZFormat": time_format, "timestampFormat": time_format}
    parsed = lines.where(F.trim("value") != "").select(
        "file", "block", "at", F.from_csv("value", with_corrupt_column(schema).simpleString()[len("struct<"):-1].replace(":", " "), options).alias("row"), "value")
    if header:
        # the first line of a file is the first of its split at byte 0
        first = lines.where("block = 0").groupBy("file").agg(F.min("at").alias("head"))
        parsed = parsed.join(first, "file", "left").where(F.col("head").isNull() | (F.col("at") != F.col("head"))).drop("head")
    fields = [F.col(f"row.`{f.name}`").alias(f.name) for f in schema]
    bad = F.col(f"row.{CORRUPT_COLUMN}").isNotNull()
    good = parsed.where(~bad).select(*fields)
    rejected = with_line_numbers(parsed.where(bad), lines)
    return good, rejected.select(*fields, F.col("value").alias(CORRUPT_COLUMN), "file", "line")
