"""Column expressions: geography, time and text (no UDFs)."""

from quarry.functions.geo import haversine_km
from quarry.functions.sql import register_sql_functions
from quarry.functions.text import (
    first_letter_class,
    is_printable_word,
    split_first,
    split_words,
)
from quarry.functions.timefn import duration_min, duration_sec, format_ntz, parse_ntz, speed_kmh

__all__ = [
    "duration_min",
    "duration_sec",
    "first_letter_class",
    "format_ntz",
    "haversine_km",
    "is_printable_word",
    "parse_ntz",
    "register_sql_functions",
    "speed_kmh",
    "split_first",
    "split_words",
]
