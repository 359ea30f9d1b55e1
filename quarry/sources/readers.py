"""Readers with declared schemas: delimited text, plain text lines, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry import schemas
from quarry.config import TIME_FORMAT
from quarry.sources.escapes import EMPTY, NULL, unescape

# Stands for null while a line is parsed; no text of a file is equal to it.
NO_VALUE = "\x01"
# Local date-times in files may carry a fraction of a second or not.
READ_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def read_delimited(spark: SparkSession, path: str, schema: StructType | None, sep: str = ",",
                   header: bool = False, infer_schema: bool = False, mode: str = "PERMISSIVE",
                   time_format: str = READ_TIME_FORMAT, corrupt_column: str | None = None,
                   multi_line: bool = False, escaped: bool = False) -> DataFrame:
    """CSV/TSV scan with a declared schema (inference only when asked for).

    ``mode``: ``PERMISSIVE`` (bad fields become null; with ``corrupt_column``
    the whole line is kept there), ``DROPMALFORMED`` or ``FAILFAST``.
    ``multi_line`` allows quoted fields with line breaks (a file is then read
    by one task, so keep files many and moderate in size).  ``escaped`` reads the
    form that ``write_delimited(escaped=True)`` writes; such files are split.
    """
    reader = spark.read.option("sep", sep).option("header", str(header).lower()).option("mode", mode)
    reader = reader.option("timestampNTZFormat", time_format).option("timestampFormat", time_format)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if multi_line:
        reader = reader.option("multiLine", "true")
    if escaped:
        out = (reader.option("quote", "").option("escape", "").option("comment", "").option("nullValue", NULL)
               .option("emptyValue", EMPTY).csv(path))
        return out.select(*[unescape(F.col(f"`{n}`"), sep).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in out.dtypes])
    # an unquoted empty field is null, a quoted one an empty string
    return reader.option("escape", '"').option("nullValue", NO_VALUE).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; the schema comes from the files."""
    return spark.read.parquet(path)


def load_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
               **options) -> DataFrame:
    """Read a table as CSV (declared schema), Parquet, or a catalog table (``fmt="table"``, ``path`` is its name)."""
    if fmt == "parquet":
        return read_parquet(spark, path)
    if fmt == "table":
        return spark.table(path)
    if fmt in ("csv", "tsv"):
        sep = options.pop("sep", "\t" if fmt == "tsv" else ",")
        return read_delimited(spark, path, schema, sep=sep, **options)
    raise ValueError(f"unknown format {fmt!r}")


def read_trips(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Trip records: CSV without header, comma separated, or Parquet."""
    return load_table(spark, path, fmt, schemas.TRIPS)


def read_vendors(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Trip vendors (``id, vendor``): CSV without header, or Parquet."""
    return load_table(spark, path, fmt, schemas.VENDORS)


def read_searches(spark: SparkSession, path: str, multi_line: bool = False, escaped: bool = False) -> DataFrame:
    """Search log: tab separated with a header line."""
    return read_delimited(spark, path, schemas.SEARCHES, sep="\t", header=True, multi_line=multi_line, escaped=escaped)


def read_titles(spark: SparkSession, path: str, multi_line: bool = False, escaped: bool = False) -> DataFrame:
    """Titles (words joined by ``_``): CSV with a header line."""
    return read_delimited(spark, path, schemas.TITLES, sep=",", header=True, multi_line=multi_line, escaped=escaped)


def read_stop_words(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Stop words, one per line, as column ``stopWords``.

    A plain word list has no header line, so by default it is read as text;
    ``header=True`` reads a one-column CSV whose first line is a header.
    """
    if header:
        return read_delimited(spark, path, schemas.STOP_WORDS, sep=",", header=True)
    return spark.read.text(path).select(F.col("value").alias("stopWords"))


def read_pairs(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Key/value pairs: the first two fields of each separated line (extra fields ignored).

    Lines are split as they are: quotes are ordinary characters and a key may be empty; the value of
    a line without a separator is null.
    """
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    fields = F.split(F.col("value"), pattern, -1)
    return read_lines(spark, path).select(fields.getItem(0).alias("k"), F.get(fields, F.lit(1)).alias("v"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines as column ``value``."""
    return spark.read.text(path)


def parse_trip_lines(lines: DataFrame, time_format: str = TIME_FORMAT, sep: str = ",") -> DataFrame:
    """Trip fields from raw text lines, bad fields as null (``try_cast`` / pattern parse)."""
    from quarry.functions.timefn import parse_ntz

    f = F.split(F.col("value"), sep)
    return lines.select(
        f.getItem(0).alias("id"),
        parse_ntz(f.getItem(1), time_format).alias("start_time"),
        parse_ntz(f.getItem(2), time_format).alias("end_time"),
        f.getItem(3).try_cast("double").alias("start_longitude"),
        f.getItem(4).try_cast("double").alias("start_latitude"),
        f.getItem(5).try_cast("double").alias("end_longitude"),
        f.getItem(6).try_cast("double").alias("end_latitude"),
        f.getItem(7).try_cast("float").alias("cost"),
    )
