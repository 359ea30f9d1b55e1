"""Registered queries: one Spark callable per key (their DuckDB oracle SQL is in ``oracle.py``).

Each callable takes ``(spark, sf_dir)``, derives the job inputs from the test
tables and returns a DataFrame.  Floating outputs are rounded to 6 decimals in
both the Spark query and the oracle (engines differ in the last bits of
``sin``/``atan2`` and in summation order); ``float`` columns are compared as
``double``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import fixtures as fx
from quarry.config import JobParams, scratch_dir
from quarry.functions.sql import register_sql_functions
from quarry.functions.text import split_first
from quarry.functions.timefn import format_ntz, parse_ntz
from quarry.operators.cleaning import clean_trips, drop_nulls
from quarry.operators.joins import STRATEGIES, broadcast_join, join, limited_side_join
from quarry.operators.joins import repartition_join as _repartition_join
from quarry.operators.joins import tagged_union as _tagged_union
from quarry.operators.prefilter import filtered_join
from quarry.operators.ranges import grouped_values, row_number_by_ranges
from quarry.operators.skew import heavy_key_join
from quarry.plans import conversions, searchlog, trips, wordindex
from quarry.sources.readers import read_parquet

P = JobParams()
R6 = 6

Query = Callable[[SparkSession, str], DataFrame]


def _r(c: str, name: str | None = None):
    return F.round(F.col(c), R6).alias(name or c)


def _trip_cols(df: DataFrame) -> DataFrame:
    """Trip columns with ``cost`` as double (compared as double)."""
    return df.withColumn("cost", F.col("cost").cast("double"))


# ---------------------------------------------------------------- trips

def q_fastest_trips(spark: SparkSession, d: str) -> DataFrame:
    out = trips.fastest_trips(fx.trips(spark, d), fx.vendors(spark, d), P)
    return out.select("id", "start_time", "vendor", _r("speed_kmh"))


def q_fastest_trips_nan_last(spark: SparkSession, d: str) -> DataFrame:
    out = trips.speed_ranking(fx.trips(spark, d), fx.vendors(spark, d), P)
    return out.select("rank", "id", "start_time", "vendor", _r("speed_kmh"))


def q_trip_mean_duration_by_hour(spark: SparkSession, d: str) -> DataFrame:
    return trips.mean_duration_by_hour(fx.trips(spark, d), P).select("hour_start", _r("duration_min"))


def q_trip_mean_duration_decimal(spark: SparkSession, d: str) -> DataFrame:
    return trips.mean_duration_by_hour(fx.trips(spark, d), P, as_decimal=True)


def q_mean_sum_count(spark: SparkSession, d: str) -> DataFrame:
    out = trips.mean_duration_sum_count(fx.trips(spark, d), P)
    return out.select("hour_start", "sum_sec", "n", _r("duration_min"))


def q_trip_max_cost_by_vendor(spark: SparkSession, d: str) -> DataFrame:
    return trips.max_cost_by_vendor(fx.trips(spark, d), fx.vendors(spark, d), P)


def q_trip_clean(spark: SparkSession, d: str) -> DataFrame:
    return _trip_cols(clean_trips(fx.trips(spark, d), P))


def q_trip_distance(spark: SparkSession, d: str) -> DataFrame:
    t = trips.with_distance(clean_trips(fx.trips(spark, d), P), P)
    return t.select("id", _r("distance_km"))


def q_trip_duration(spark: SparkSession, d: str) -> DataFrame:
    t = trips.with_duration(fx.trips(spark, d))
    return t.select("id", "duration_sec", _r("duration_min"))


def q_trip_vendor_join(spark: SparkSession, d: str) -> DataFrame:
    return _trip_cols(trips.trips_with_vendor(fx.trips(spark, d), fx.vendors(spark, d), P))


def q_limited_side_join(spark: SparkSession, d: str) -> DataFrame:
    return _trip_cols(limited_side_join(fx.trips(spark, d), fx.vendors(spark, d), "id", 100, "id"))


# ---------------------------------------------------------------- search log

def _calendar(unit: str) -> Query:
    def q(spark: SparkSession, d: str) -> DataFrame:
        return searchlog.calendar_counts(fx.search_log(spark, d), unit)
    q.__name__ = f"q_searches_per_{unit}"
    return q


def q_search_success(spark: SparkSession, d: str) -> DataFrame:
    out = searchlog.success_ratio(fx.search_log(spark, d))
    return out.select("total", "successes", _r("success_pct"), _r("failure_pct"))


def q_popular_urls(spark: SparkSession, d: str) -> DataFrame:
    return searchlog.popular_urls(fx.search_log(spark, d), P)


def q_keyword_counts(spark: SparkSession, d: str) -> DataFrame:
    return searchlog.keyword_counts(fx.search_texts(spark, d), P.keyword_top, weight="n")


def q_distinct_keywords(spark: SparkSession, d: str) -> DataFrame:
    return searchlog.distinct_keywords(fx.search_texts(spark, d))


def q_printable_words(spark: SparkSession, d: str) -> DataFrame:
    return searchlog.title_words(fx.titles(spark, d)).select("title_id", "title")


def q_title_first_letters(spark: SparkSession, d: str) -> DataFrame:
    out = searchlog.title_first_letters(fx.titles(spark, d))
    return out.select("first_letter", "appearances", _r("frequency"))


def q_title_word_export(spark: SparkSession, d: str) -> DataFrame:
    return conversions.title_word_export(spark, fx.titles(spark, d))


def q_distinct_words(spark: SparkSession, d: str) -> DataFrame:
    return searchlog.distinct_title_words(fx.titles(spark, d))


def _non_stop_words(spark: SparkSession, d: str) -> DataFrame:
    # the fixture stop list is a literal list of six words: bounded by construction
    # (a text that many searches share is split once)
    return searchlog.remove_stop_words(searchlog.search_words(fx.search_texts(spark, d), "doc_id"), fx.stop_words(spark),
                                       stops_bounded=True)


def q_remove_stop_words(spark: SparkSession, d: str) -> DataFrame:
    return _non_stop_words(spark, d).select("doc_id", "title")


def q_stop_words_file(spark: SparkSession, d: str) -> DataFrame:
    stops = conversions.stop_list_file(spark, fx.table(spark, d, "benchmark"))
    words = searchlog.search_words(fx.search_texts(spark, d), "doc_id")
    return searchlog.remove_stop_words(words, stops).select("doc_id", "title")


def q_dedup_by_key(spark: SparkSession, d: str) -> DataFrame:
    searched = _non_stop_words(spark, d).dropDuplicates(["doc_id"]).select("doc_id")
    return fx.search_ids(spark, d).join(searched, "doc_id").select("event_id")


def q_search_title_match(spark: SparkSession, d: str) -> DataFrame:
    out = searchlog.search_title_match(fx.search_texts(spark, d), fx.titles(spark, d), fx.stop_words(spark),
                                       id_col="doc_id", stops_bounded=True, weight="n")
    return out.select("matched", "searchable", _r("match_pct"), "matched_words")


def q_search_row_number(spark: SparkSession, d: str) -> DataFrame:
    return row_number_by_ranges(fx.search_log(spark, d), ["userid", "event_id"], "row_num")


def q_split_first(spark: SparkSession, d: str) -> DataFrame:
    s = fx.searches(spark, d).select(
        "event_id", F.concat_ws(",", F.col("event_id").cast("string"), "userid", "keywords").alias("line"))
    parts = split_first("line", ",")
    return s.select("event_id", parts.getItem(0).alias("head"), parts.getItem(1).alias("rest"))


def q_drop_nulls(spark: SparkSession, d: str) -> DataFrame:
    return drop_nulls(fx.search_log(spark, d), ["pos", "url"]).select("event_id", "pos", "url")


def q_parse_timestamps(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events")
    text = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(format_ntz("ts"))
    s = e.select("event_id", text.alias("ts_text"))
    return s.select("event_id", "ts_text", parse_ntz("ts_text").alias("parsed"))


def q_sql_functions(spark: SparkSession, d: str) -> DataFrame:
    register_sql_functions(spark)
    # the trips frame is bound into the SQL text directly: no shared temp view name
    return spark.sql("""
        SELECT id,
               round(haversine(start_longitude, start_latitude, end_longitude, end_latitude), 6) AS distance_km,
               round(duration_min(start_time, end_time), 6) AS duration_min
        FROM {trips}
        WHERE (start_latitude <> end_latitude OR start_longitude <> end_longitude)
          AND end_time > start_time
          AND start_latitude BETWEEN 40 AND 46 AND end_latitude BETWEEN 40 AND 46
          AND start_longitude BETWEEN -80 AND -70 AND end_longitude BETWEEN -80 AND -70""",
                     trips=fx.trips(spark, d))


# ---------------------------------------------------------------- joins

def q_repartition_join(spark: SparkSession, d: str) -> DataFrame:
    j = _repartition_join(fx.order_pairs(spark, d), fx.lineitem_pairs(spark, d))
    return j.select("k", "lv", "rv", F.concat_ws(", ", F.col("k").cast("string"), "lv", "rv").alias("line"))


def q_broadcast_join(spark: SparkSession, d: str) -> DataFrame:
    j = broadcast_join(fx.customer_pairs(spark, d), fx.nation_pairs(spark, d))
    return j.select("k", "lv", "rv", F.concat_ws(", ", F.col("k").cast("string"), "lv", "rv").alias("line"))


def q_join_strategies(spark: SparkSession, d: str) -> DataFrame:
    li = fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    outs = []
    for s in STRATEGIES:
        j = join(li, orders, li.l_orderkey == orders.o_orderkey, "inner", strategy=s)
        outs.append(j.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("sum_key"),
                          F.sum("l_linenumber").cast("long").alias("sum_line"),
                          F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"))
                    .select(F.lit(s).alias("strategy"), "*"))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def q_grouped_values(spark: SparkSession, d: str) -> DataFrame:
    t = trips.with_duration(clean_trips(fx.trips(spark, d), P)).select(F.hour("start_time").alias("hour_start"), "duration_sec", "id")
    pages = grouped_values(t, "hour_start", "duration_sec", ["id"], page_size=100)
    return pages.select("hour_start", "page", "n", F.array_join(F.col("values").cast("array<string>"), ",").alias("durations"))


def q_merged_mean_sum_count(spark: SparkSession, d: str) -> DataFrame:
    # three deliveries, by the day of the month
    base, t = scratch_dir(spark, "duration-state"), fx.trips(spark, d)
    for k in range(3):
        trips.advance_durations(spark, base, t.where(F.dayofmonth("start_time") % 3 == k), P)
    return trips.mean_duration_from_state(spark, base).select("hour_start", "sum_sec", "n", _r("duration_min"))


def q_merged_popular_urls(spark: SparkSession, d: str) -> DataFrame:
    base, log = scratch_dir(spark, "visitor-state"), fx.search_log(spark, d)
    for k in range(3):
        searchlog.advance_visitors(spark, base, log.where(F.dayofyear("date") % 3 == k))
    return searchlog.popular_urls_from_state(spark, base, P)


def _word_index(spark: SparkSession, d: str) -> wordindex.WordIndex:
    return wordindex.write_word_index(spark, fx.search_texts(spark, d), fx.titles(spark, d), scratch_dir(spark, "word-index"),
                                      id_col="doc_id", weight="n")


def q_word_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return _word_index(spark, d).dictionary.select("word", "id", "n", "searches", "titles")


def q_encoded_keyword_counts(spark: SparkSession, d: str) -> DataFrame:
    return wordindex.keyword_counts(_word_index(spark, d), P.keyword_top)


def q_encoded_first_letters(spark: SparkSession, d: str) -> DataFrame:
    return wordindex.title_first_letters(_word_index(spark, d)).select("first_letter", "appearances", _r("frequency"))


def q_encoded_title_match(spark: SparkSession, d: str) -> DataFrame:
    out = wordindex.search_title_match(_word_index(spark, d), fx.stop_words(spark), stops_bounded=True)
    return out.select("matched", "searchable", _r("match_pct"), "matched_words")


def q_published_trips(spark: SparkSession, d: str) -> DataFrame:
    return _trip_cols(conversions.published_trips(spark, clean_trips(fx.trips(spark, d), P)))


def q_rejected_origins(spark: SparkSession, d: str) -> DataFrame:
    return conversions.rejected_trip_origins(spark, fx.table(spark, d, "events")).select("id", "folder", "line")


def q_heavy_key_join(spark: SparkSession, d: str) -> DataFrame:
    # a third of the lineitems under one order
    hot = fx.lineitem_pairs(spark, d).select(F.when(F.col("k") % 3 == 0, F.lit(1)).otherwise(F.col("k")).alias("k"), F.col("v").alias("rv"), F.col("k").alias("own"))
    j = heavy_key_join(fx.order_pairs(spark, d).withColumnRenamed("v", "lv"), hot)
    return j.select("k", "lv", "rv", "own")


def q_filtered_join(spark: SparkSession, d: str) -> DataFrame:
    urgent = fx.order_pairs(spark, d).where("v = '1-URGENT'").withColumnRenamed("v", "rv")
    return filtered_join(fx.lineitem_pairs(spark, d).withColumnRenamed("v", "lv"), urgent).select("k", "lv", "rv")


def q_pair_files_join(spark: SparkSession, d: str) -> DataFrame:
    return conversions.pair_files_join(spark, fx.order_pairs(spark, d), fx.lineitem_pairs(spark, d))


def q_tagged_union(spark: SparkSession, d: str) -> DataFrame:
    return _tagged_union(fx.order_pairs(spark, d), fx.lineitem_pairs(spark, d))


# ---------------------------------------------------------------- sources and sinks

def q_parquet_scan(spark: SparkSession, d: str) -> DataFrame:
    return read_parquet(spark, f"{d.rstrip('/')}/lineitem.parquet")


def q_parquet_convert(spark: SparkSession, d: str) -> DataFrame:
    return _trip_cols(conversions.parquet_convert(spark, fx.trips(spark, d), fx.vendors(spark, d)))


def q_csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return _trip_cols(conversions.csv_round_trip(spark, fx.trips(spark, d)))


def q_tsv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return conversions.tsv_round_trip(spark, fx.searches(spark, d))


def q_text_line_parse(spark: SparkSession, d: str) -> DataFrame:
    out = conversions.parse_trip_text(spark, fx.table(spark, d, "events"))
    return _trip_cols(out)


def q_rejected_rows(spark: SparkSession, d: str) -> DataFrame:
    good, rejected = conversions.rejected_trip_lines(spark, fx.table(spark, d, "events"))
    cols = ["id", "start_time", "end_time", F.col("cost").cast("double").alias("cost")]
    return good.select(*cols, F.lit(False).alias("is_rejected")).unionByName(
        rejected.select(*cols, F.lit(True).alias("is_rejected")))


QUERIES: dict[str, Query] = {
    "fastest_trips": q_fastest_trips,
    "trip_mean_duration_by_hour": q_trip_mean_duration_by_hour,
    "trip_mean_duration_decimal": q_trip_mean_duration_decimal,
    "trip_max_cost_by_vendor": q_trip_max_cost_by_vendor,
    "trip_clean": q_trip_clean,
    "trip_distance": q_trip_distance,
    "trip_duration": q_trip_duration,
    "trip_vendor_join": q_trip_vendor_join,
    "searches_per_day": _calendar("day"),
    "searches_per_week": _calendar("week"),
    "searches_per_month": _calendar("month"),
    "search_success": q_search_success,
    "popular_urls": q_popular_urls,
    "keyword_counts": q_keyword_counts,
    "distinct_keywords": q_distinct_keywords,
    "printable_words": q_printable_words,
    "title_first_letters": q_title_first_letters,
    "title_word_export": q_title_word_export,
    "distinct_words": q_distinct_words,
    "remove_stop_words": q_remove_stop_words,
    "stop_words_file": q_stop_words_file,
    "search_title_match": q_search_title_match,
    "dedup_by_key": q_dedup_by_key,
    "repartition_join": q_repartition_join,
    "broadcast_join": q_broadcast_join,
    "join_strategies": q_join_strategies,
    "limited_side_join": q_limited_side_join,
    "tagged_union": q_tagged_union,
    "parquet_scan": q_parquet_scan,
    "parquet_convert": q_parquet_convert,
    "csv_round_trip": q_csv_round_trip,
    "tsv_round_trip": q_tsv_round_trip,
    "rejected_rows": q_rejected_rows,
    "split_first": q_split_first,
    "drop_nulls": q_drop_nulls,
    "mean_sum_count": q_mean_sum_count,
    "parse_timestamps": q_parse_timestamps,
    "search_row_number": q_search_row_number,
    "fastest_trips_nan_last": q_fastest_trips_nan_last,
    "pair_files_join": q_pair_files_join,
    "sql_functions": q_sql_functions,
    "text_line_parse": q_text_line_parse,
    "grouped_values": q_grouped_values,
    "heavy_key_join": q_heavy_key_join,
    "filtered_join": q_filtered_join,
    "merged_mean_sum_count": q_merged_mean_sum_count,
    "merged_popular_urls": q_merged_popular_urls,
    "published_trips": q_published_trips,
    "word_dictionary": q_word_dictionary,
    "encoded_keyword_counts": q_encoded_keyword_counts,
    "encoded_first_letters": q_encoded_first_letters,
    "encoded_title_match": q_encoded_title_match,
    "rejected_origins": q_rejected_origins,
}
