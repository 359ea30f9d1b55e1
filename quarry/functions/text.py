"""Text column expressions for search keywords and title words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions._columns import col_of

# Fixed values shared with the original jobs: a word counts when its first
# character is printable ASCII (codes 33..126); first-letter classes are the
# upper-cased letter, or these two labels for digits and everything else.
PRINTABLE_MIN, PRINTABLE_MAX = 33, 126
NUMBER_CLASS = "0Number"
SYMBOL_CLASS = "!Symbol"


def is_printable_word(word: Column | str) -> Column:
    """True when the word is non-null, non-empty and starts with a printable ASCII char (33..126).

    ``ascii`` gives 0 for the empty string and the code point (> 126) for a
    non-ASCII first character, so one range test covers every case; the
    ``coalesce`` turns a null word into false.
    """
    return F.coalesce(F.ascii(col_of(word)).between(PRINTABLE_MIN, PRINTABLE_MAX), F.lit(False))


def first_letter_class(word: Column | str) -> Column:
    """Class of the first character: the letter upper-cased (``A``..``Z``), ``0Number`` or ``!Symbol``."""
    code = F.ascii(col_of(word))
    first = F.substring(col_of(word), 1, 1)
    return (
        F.when(code.between(65, 90) | code.between(97, 122), F.upper(first))
        .when(code.between(48, 57), F.lit(NUMBER_CLASS))
        .otherwise(F.lit(SYMBOL_CLASS))
    )


def split_words(text: Column | str, sep: str = " ") -> Column:
    """Split on a literal separator, keeping empty tokens (``'a  b '`` -> ``a,'',b,''``)."""
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return F.split(col_of(text), pattern)


def split_first(text: Column | str, sep: str = ",") -> Column:
    """Split only on the first separator: ``[head, rest]`` (rest null when absent)."""
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return F.split(col_of(text), pattern, 2)

