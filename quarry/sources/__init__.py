"""Sources and sinks: delimited text, plain text and Parquet with declared schemas."""

from quarry.sources.origin import read_with_origin
from quarry.sources.publish import current_version, publish, published, remove_old, versions
from quarry.sources.readers import (
    load_table,
    parse_trip_lines,
    read_delimited,
    read_lines,
    read_pairs,
    read_parquet,
    read_searches,
    read_stop_words,
    read_titles,
    read_trips,
    read_vendors,
)
from quarry.sources.rejects import read_with_rejects, split_rejected
from quarry.sources.writers import write_bucketed_table, write_delimited, write_parquet, write_text

__all__ = [
    "current_version",
    "load_table",
    "parse_trip_lines",
    "publish",
    "published",
    "read_delimited",
    "read_lines",
    "read_pairs",
    "read_parquet",
    "read_searches",
    "read_stop_words",
    "read_titles",
    "read_trips",
    "read_vendors",
    "read_with_origin",
    "read_with_rejects",
    "remove_old",
    "split_rejected",
    "versions",
    "write_bucketed_table",
    "write_delimited",
    "write_parquet",
    "write_text",
]
