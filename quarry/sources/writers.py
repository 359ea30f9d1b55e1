"""Sinks: Parquet, delimited text and plain text, with the save mode as a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import range_sorted
from quarry.sources.escapes import EMPTY, NULL, escape

WRITE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write Parquet; by default fail when the target exists."""
    df.write.mode(mode).parquet(path)
    return path


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = False, mode: str = "errorifexists",
                    num_files: int | None = None, sort_by: Sequence[Column | str] = (),
                    tie_break: Sequence[Column | str] = (), columns: Sequence[str] | None = None,
                    time_format: str = WRITE_TIME_FORMAT, escaped: bool = False, compression: str | None = None,
                    rows_per_file: int | None = None) -> str:
    """Write CSV/TSV; every value comes back as it was (white space, quotes, empty strings).

    In the plain form a null is an unquoted empty field, an empty string a quoted one, and a
    field with a line break is quoted over several lines, so such a file cannot be split when
    read.  ``escaped`` writes line breaks, separators and backslashes as backslash
    codes and null as ``\\N``: one line per row, without quotes; read it with ``escaped=True``.

    With ``sort_by`` the rows are range-partitioned into ``num_files`` files
    (``None``: as many as AQE's partition sizing gives), each sorted, so
    reading the files in name order gives the global order (a sort followed by
    a round-robin repartition would lose it).  ``tie_break`` columns only shape file boundaries (not written unless
    in ``columns``): a frequent key can then spread over several files.
    ``columns`` are the columns written (default: all).

    ``compression`` names a codec of the files (``gzip``; readers find it by the file name, and do not split such
    files); ``rows_per_file`` bounds the rows of a file, a task then writes several.
    """
    out = df
    if sort_by:
        out = range_sorted(df, num_files, sort_by, tie_break)
    elif num_files:
        # round-robin; retry-safe through spark.sql.execution.sortBeforeRepartition (on by default)
        out = df.repartition(num_files)
    keep = list(columns) if columns is not None else df.columns
    out = out.select(*keep)
    if escaped:
        out = out.select(*[escape(F.col(f"`{n}`"), sep).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in out.dtypes])
    writer = (
        out.write.mode(mode)
        .option("sep", sep).option("header", str(header).lower())
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .option("timestampNTZFormat", time_format).option("timestampFormat", time_format)
    )
    if escaped:
        writer = writer.option("quote", "").option("escape", "").option("nullValue", NULL).option("emptyValue", EMPTY)
    else:
        writer = writer.option("escape", '"').option("emptyValue", '""')
    if compression:
        writer = writer.option("compression", compression)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)
    return path


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a single string column as text lines (overwriting by default)."""
    if len(df.columns) != 1:
        raise ValueError("text sink needs exactly one string column")
    df.write.mode(mode).text(path)
    return path


def write_bucketed_table(df: DataFrame, table: str, key: str, buckets: int, path: str,
                         mode: str = "errorifexists") -> str:
    """Write an external Parquet table bucketed and sorted by ``key`` at ``path``; returns the table name.

    Two tables bucketed the same way on the join key join without a shuffle:
    the sort-merge join reads bucket ``i`` of both sides in the same task.
    Worth it when the same large tables are joined by several queries.
    The rows are first hash-partitioned on ``key`` into ``buckets`` partitions
    (the hash Spark uses for bucket ids), so each task writes the file of one
    bucket: ``buckets`` files in all, not one per bucket per input task.
    """
    (df.repartition(buckets, key).write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return table
