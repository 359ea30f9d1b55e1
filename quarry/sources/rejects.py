"""Malformed input rows: keep what parses, route whole bad lines to a rejected frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.schemas import CORRUPT_COLUMN, with_corrupt_column
from quarry.sources.readers import READ_TIME_FORMAT, read_delimited


def read_with_rejects(spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = False,
                      time_format: str = READ_TIME_FORMAT) -> tuple[DataFrame, DataFrame]:
    """Read delimited text into ``(good, rejected)``.

    Parsing is ``PERMISSIVE``: in a malformed line the fields that parse are
    kept, the others are null, and the raw line goes to ``_corrupt_record``.
    Which lines count as malformed depends on which columns the CSV parser is
    asked to convert, so both outputs ask for all of them: they see the same
    verdict for every line, without a copy of the table.
    """
    parsed = read_delimited(spark, path, with_corrupt_column(schema), sep=sep, header=header,
                            time_format=time_format, corrupt_column=CORRUPT_COLUMN)
    return split_rejected(parsed)


def split_rejected(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a permissively parsed frame on its ``_corrupt_record`` column."""
    # the test names every column, so that each of them is parsed whatever a query uses
    every = F.hash(*[F.col(f"`{c}`") for c in parsed.columns if c != CORRUPT_COLUMN])
    bad = F.concat(F.col(CORRUPT_COLUMN), every.cast("string")).isNotNull()
    good = parsed.filter(~bad).drop(CORRUPT_COLUMN)
    rejected = parsed.filter(bad)
    return good, rejected
