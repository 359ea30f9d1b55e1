"""Backslash codes of the escaped delimited form: one line per row, no quotes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL, EMPTY = "\\N", "\\E"
_CODES = (("\n", "\\n"), ("\r", "\\r"), ("\x00", "\\0"))


def escape(c: Column, sep: str) -> Column:
    """The string without line breaks, NUL and separators; an empty one as ``EMPTY``."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for plain, code in (*_CODES, (sep, "\\s")):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return F.when(out == "", F.lit(EMPTY)).otherwise(out)


def unescape(c: Column, sep: str) -> Column:
    """The inverse of :func:`escape`."""

    def plain_part(part: Column) -> Column:
        for plain, code in (*_CODES, (sep, "\\s")):
            part = F.replace(part, F.lit(code), F.lit(plain))
        return part

    parts = F.split(c, r"\\\\", -1)  # at escaped backslashes; what is between holds codes only
    return F.when(c == EMPTY, F.lit("")).otherwise(F.array_join(F.transform(parts, plain_part), "\\"))
