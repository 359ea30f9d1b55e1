"""Relational operators: cleaning, joins with a chosen strategy, ordering."""

from quarry.operators.cleaning import clean_trips, distinct_endpoints, drop_nulls, inside_box, positive_duration
from quarry.operators.dictionary import Encoded, encode, write_dictionary
from quarry.operators.inspect import join_operators, plan_string
from quarry.operators.joins import (
    STRATEGIES,
    broadcast_join,
    fits_broadcast,
    format_pairs,
    hinted,
    join,
    limited_side_join,
    repartition_join,
    tagged_union,
)
from quarry.operators.ordering import dense_row_number, desc_nan_last, persisted, range_sorted, top_k
from quarry.operators.prefilter import filtered_join, prefiltered
from quarry.operators.ranges import grouped_values, range_id, row_number_by_ranges, splitters
from quarry.operators.skew import heavy_key_join, heavy_keys

__all__ = [
    "Encoded",
    "STRATEGIES",
    "broadcast_join",
    "clean_trips",
    "dense_row_number",
    "desc_nan_last",
    "distinct_endpoints",
    "drop_nulls",
    "encode",
    "filtered_join",
    "fits_broadcast",
    "format_pairs",
    "grouped_values",
    "heavy_key_join",
    "heavy_keys",
    "hinted",
    "inside_box",
    "join",
    "join_operators",
    "limited_side_join",
    "persisted",
    "plan_string",
    "positive_duration",
    "prefiltered",
    "range_id",
    "range_sorted",
    "repartition_join",
    "row_number_by_ranges",
    "splitters",
    "tagged_union",
    "top_k",
    "write_dictionary",
]
