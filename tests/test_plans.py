"""Plan properties of every registered query: no Python UDF, no cartesian product,
filters pushed into the scan, columns pruned, results of the twin forms equal."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from quarry import fixtures as fx
from quarry.operators import clean_trips
from quarry.plans import searchlog, trips
from quarry.plans.catalog import QUERIES

# keys whose callables write files when built; their read-back plans are plain scans
WRITERS = {"title_word_export", "parquet_convert", "csv_round_trip", "tsv_round_trip", "rejected_rows",
           "pair_files_join", "text_line_parse",
           # they read what they have published or written from the tables
           "merged_mean_sum_count", "merged_popular_urls", "published_trips", "rejected_origins"}
# these number rows of a checkpoint: their plans scan that copy
CHECKPOINTED = {"fastest_trips_nan_last"}
# these write a word index of the tables first: their plans scan it
INDEXED = {"word_dictionary", "encoded_keyword_counts", "encoded_first_letters", "encoded_title_match"}
KEYS = sorted(k for k in QUERIES if k not in WRITERS)


@pytest.mark.parametrize("key", KEYS)
def test_plan_has_no_python_udf_or_cartesian(spark, sf_small, key):
    plan = plan_text(QUERIES[key](spark, sf_small))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{key}: {bad}"


def test_cleaning_filters_pushed_to_parquet(spark, sf_small):
    path = f"{sf_small}/lineitem.parquet"
    li = spark.read.parquet(path)
    df = li.filter(F.col("l_quantity").between(10, 20)).select("l_orderkey")
    plan = plan_text(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,10.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_trip_bounds_pushed_when_reading_parquet(spark, sf_small, tmp_path_factory):
    from quarry.config import scratch_dir

    path = scratch_dir(spark, "trips-pq")
    fx.trips(spark, sf_small).write.parquet(path)
    t = spark.read.parquet(path)
    plan = plan_text(trips.mean_duration_by_hour(t))
    assert "GreaterThanOrEqual(start_latitude,40.0)" in plan
    # the question needs 6 of the 8 columns
    assert "ReadSchema: struct<start_time:timestamp_ntz,end_time:timestamp_ntz,start_longitude:double" in plan
    assert "cost" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_fastest_trips_computes_speed_before_join(spark, sf_small):
    plan = plan_text(trips.fastest_trips(fx.trips(spark, sf_small), fx.vendors(spark, sf_small),
                                         strategy="merge"))
    assert "TakeOrderedAndProject" in plan
    # only id, start_time and the speed cross the shuffle of the trip side
    assert re.search(r"Exchange\nInput \[3\]: \[id#\d+, start_time#\d+, speed_kmh#\d+\]", plan)


def test_popular_urls_distinct_in_two_steps(spark, sf_small):
    plan = plan_text(searchlog.popular_urls(fx.search_log(spark, sf_small)))
    assert plan.count("HashAggregate") >= 4


@pytest.mark.parametrize("key", ["searches_per_day", "searches_per_week", "searches_per_month", "search_success",
                                 "popular_urls", "drop_nulls"])
def test_log_questions_join_nothing(spark, sf_small, key):
    plan = plan_text(QUERIES[key](spark, sf_small))
    assert "Join" not in plan and "documents.parquet" not in plan


def test_word_queries_cover_every_word(spark, sf_small):
    # the tokens of all documents, weighted by the searches of each
    docs = fx.table(spark, sf_small, "documents")
    words = docs.select("doc_id", F.size(F.split("text", " ", -1)).alias("w"))
    want = words.join(fx.search_ids(spark, sf_small), "doc_id").agg(F.sum("w")).first()[0]
    assert QUERIES["keyword_counts"](spark, sf_small).agg(F.sum("appearances")).first()[0] == want
    titles = fx.titles(spark, sf_small)
    assert titles.select(F.sum(F.size(F.split("title", "_", -1)))).first()[0] >= words.agg(F.sum("w")).first()[0]
    assert titles.count() == docs.count()


def test_speed_ranking_holds_infinity_numbers_and_nan(spark):
    rows = QUERIES["fastest_trips_nan_last"](spark, "/root/testdata/sf0.01").orderBy("rank").collect()
    kinds = ["inf" if r.speed_kmh == float("inf") else "nan" if r.speed_kmh != r.speed_kmh else "number" for r in rows]
    assert [k for i, k in enumerate(kinds) if i == 0 or kinds[i - 1] != k] == ["inf", "number", "nan"]
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))

def test_mean_twins_agree(spark, sf_small):
    t = fx.trips(spark, sf_small)
    a = {r.hour_start: round(r.duration_min, 9) for r in trips.mean_duration_by_hour(t).collect()}
    b = {r.hour_start: round(r.duration_min, 9) for r in trips.mean_duration_sum_count(t).collect()}
    assert a == b and len(a) == 24
    dec = trips.mean_duration_by_hour(t, as_decimal=True)
    assert dict(dec.dtypes)["duration_min"] == "decimal(32,2)"


def test_letter_frequencies_sum_to_100(spark, sf_small):
    rows = searchlog.title_first_letters(fx.titles(spark, sf_small)).collect()
    assert abs(sum(r.frequency for r in rows) - 100.0) < 1e-9


def test_distance_symmetric_nonnegative(spark, sf_small):
    from quarry.functions.geo import haversine_km

    t = clean_trips(fx.trips(spark, sf_small))
    d = t.select(haversine_km("start_longitude", "start_latitude", "end_longitude", "end_latitude").alias("a"),
                 haversine_km("end_longitude", "end_latitude", "start_longitude", "start_latitude").alias("b"))
    assert d.filter((F.col("a") < 0) | (F.abs(F.col("a") - F.col("b")) > 1e-9)).count() == 0


def test_calendar_by_year_and_iso_week(spark):
    import datetime as dt

    rows = [(dt.datetime(2006, 1, 1, 12),), (dt.datetime(2006, 3, 1, 12),), (dt.datetime(2007, 3, 1, 12),)]
    s = spark.createDataFrame(rows, "date timestamp_ntz")
    weeks = {r.week_of_year: r.searches_per_week for r in searchlog.calendar_counts(s, "week").collect()}
    assert weeks[52] == 1
    iso = {(r.year, r.week_of_year) for r in searchlog.calendar_counts(s, "week", by_year=True).collect()}
    assert (2005, 52) in iso
    days = {r.day_of_year: r.searches_per_day for r in searchlog.calendar_counts(s, "day").collect()}
    assert days[60] == 2
    by_year = searchlog.calendar_counts(s, "month", by_year=True).collect()
    assert [(r.year, r.month_of_year, r.searches_per_month) for r in by_year] == [(2006, 1, 1), (2006, 3, 1),
                                                                                   (2007, 3, 1)]


@pytest.mark.parametrize("unit,duck_fn,duck_year", [("day", "dayofyear", "year"), ("week", "weekofyear", "isoyear"),
                                                    ("month", "month", "year")])
def test_calendar_counts_over_years_match_duckdb(spark, sf_small, unit, duck_fn, duck_year):
    # the search log spans one month; order dates span 1995-2001 (all months, ISO week 53)
    from oracle_check import duck

    orders = fx.table(spark, sf_small, "orders").withColumnRenamed("o_orderdate", "date")
    got = {tuple(r) for r in searchlog.calendar_counts(orders, unit, by_year=True).collect()}
    con = duck(sf_small)
    want = {tuple(r) for r in con.execute(
        f"SELECT {duck_year}(o_orderdate), {duck_fn}(o_orderdate), count(*) FROM orders GROUP BY 1, 2").fetchall()}
    assert got == want
    if unit == "week":
        assert any(w == 53 for _, w, _ in got)


def test_stop_list_broadcast_even_without_auto_broadcast(spark, sf_small):
    from quarry.operators import join_operators

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        words = searchlog.search_words(fx.searches(spark, sf_small))
        ops = join_operators(searchlog.remove_stop_words(words, fx.stop_words(spark)))
        assert "BroadcastHashJoin LeftAnti" in ops
        ops = join_operators(searchlog.remove_stop_words(words, fx.stop_words(spark), stops_bounded=True))
        assert "BroadcastHashJoin LeftAnti" in ops
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fastest_trips_details(spark, sf_small):
    t, v = fx.trips(spark, sf_small), fx.vendors(spark, sf_small)
    plain = trips.fastest_trips(t, v).collect()
    rich = trips.fastest_trips(t, v, details=True).collect()
    assert [r.id for r in rich] == [r.id for r in plain]
    for r in rich:
        assert abs(r.speed_kmh - r.distance_km / (r.duration_sec / 3600.0)) < 1e-6 * r.speed_kmh


def test_stop_words_case_sensitive_unless_folded(spark):
    words = spark.createDataFrame([(1, "The"), (1, "cat"), (2, "the")], "event_id long, title string")
    stops = spark.createDataFrame([("the",)], "stopWords string")
    kept = sorted(r.title for r in searchlog.remove_stop_words(words, stops).collect())
    assert kept == ["The", "cat"]
    folded = sorted(r.title for r in searchlog.remove_stop_words(words, stops, fold_case=True).collect())
    assert folded == ["cat"]


@pytest.mark.parametrize("key", [k for k in KEYS if k not in CHECKPOINTED | INDEXED])
def test_query_scans_the_test_tables(spark, sf_small, key):
    # every registered query reads the given tables (writers read files derived from them)
    plan = plan_text(QUERIES[key](spark, sf_small))
    assert f"{sf_small}/" in plan and "Scan parquet" in plan


@pytest.mark.parametrize("key", sorted(INDEXED))
def test_query_scans_the_word_index(spark, sf_small, key):
    plan = plan_text(QUERIES[key](spark, sf_small))
    assert "/word-index" in plan and "Scan parquet" in plan
