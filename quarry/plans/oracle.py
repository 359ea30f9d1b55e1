"""DuckDB SQL for every registered query (the independent oracle).

Written directly from the query semantics over the pre-registered test-table
views; it shares no code path with the Spark side.  Integer keys produced by
DuckDB date functions (BIGINT) are cast to INTEGER to match Spark's types.
"""

from __future__ import annotations


def _hav(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    a = (f"least(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin(radians({lon2} - {lon1}) / 2), 2), 1.0::DOUBLE)")
    return f"(6371.0::DOUBLE * (2.0::DOUBLE * atan2(sqrt({a}), sqrt(1.0::DOUBLE - {a}))))"


_LON0 = "(-80.5::DOUBLE + (event_id*37%1100)/100::DOUBLE)"
_LAT0 = "(39.5::DOUBLE + (event_id*53%700)/100::DOUBLE)"

TRIPS = f"""trips AS (
  SELECT CAST(event_id AS VARCHAR) id, ts start_time,
    CASE WHEN event_id%388=0 THEN ts ELSE ts + to_seconds(CAST(floor(value*10) AS INTEGER) - 60) END end_time,
    {_LON0} start_longitude, {_LAT0} start_latitude,
    CASE WHEN event_id%97=0 THEN {_LON0} ELSE -80.5::DOUBLE + (event_id*71%1100)/100::DOUBLE END end_longitude,
    CASE WHEN event_id%97=0 THEN {_LAT0} ELSE 39.5::DOUBLE + (event_id*91%700)/100::DOUBLE END end_latitude,
    CAST(value AS FLOAT) cost
  FROM events)"""

VENDORS = """vendors AS (
  SELECT CAST(event_id AS VARCHAR) id, CAST(user_id%3+1 AS VARCHAR) vendor FROM events WHERE event_type <> 'error')"""

CLEAN = """clean AS (
  SELECT * FROM trips
  WHERE (start_latitude <> end_latitude OR start_longitude <> end_longitude)
    AND end_time > start_time
    AND start_latitude BETWEEN 40 AND 46 AND end_latitude BETWEEN 40 AND 46
    AND start_longitude BETWEEN -80 AND -70 AND end_longitude BETWEEN -80 AND -70)"""

_LOG_COLS = """e.event_id, CAST(e.user_id AS VARCHAR) userid, e.ts + to_days(CAST(e.event_id%2000 AS INTEGER)) date,
    CASE WHEN e.event_type IN ('click','view','purchase') THEN CAST(e.event_id%10+1 AS INTEGER) END pos,
    CASE WHEN e.event_type IN ('click','view','purchase')
         THEN concat('http://site', CAST(e.event_id*7%40 AS VARCHAR), '.example/') END url"""

LOG = f"log AS (SELECT {_LOG_COLS} FROM events e)"

SEARCHES = f"""searches AS (
  SELECT {_LOG_COLS}, k.doc_id, k.text keywords
  FROM events e JOIN documents k ON k.doc_id = e.event_id % (SELECT count(*) FROM documents))"""

# each searched text once, with the number of its searches
TEXTS = """texts AS (
  SELECT k.doc_id, k.text keywords, n FROM documents k
  JOIN (SELECT event_id % (SELECT count(*) FROM documents) doc_id, count(*) n FROM events GROUP BY 1) c USING (doc_id))"""

TITLES = """titles AS (SELECT doc_id title_id, replace(text, ' ', '_') title FROM documents)"""

WORDS = """words AS (
  SELECT title_id, title FROM (SELECT title_id, unnest(string_split(title, '_')) title FROM titles)
  WHERE ascii(title) BETWEEN 33 AND 126)"""

STOPS = """stops(stopWords) AS (VALUES ('the'), ('and'), ('of'), ('that'), ('in'), ('is'))"""

NON_STOP = """kw AS (
  SELECT doc_id, title FROM (SELECT doc_id, unnest(string_split(keywords, ' ')) title FROM texts) s
  WHERE ascii(title) BETWEEN 33 AND 126
    AND NOT EXISTS (SELECT 1 FROM stops WHERE stops.stopWords = s.title))"""

DUR_MIN = "(date_sub('second', start_time, end_time) / 60::DOUBLE)"
DIST = _hav("start_longitude", "start_latitude", "end_longitude", "end_latitude")
def _trip_cols(alias: str = "") -> str:
    """Trip columns (``cost`` as DOUBLE), optionally qualified by a table alias."""
    p = f"{alias}." if alias else ""
    cols = ["id", "start_time", "end_time", "start_longitude", "start_latitude", "end_longitude", "end_latitude"]
    return ", ".join(f"{p}{c}" for c in cols) + f", CAST({p}cost AS DOUBLE) cost"


TRIP_COLS = _trip_cols()


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _speed_rows(source: str, zero: str = "NULL") -> str:
    return f"""sp AS (
  SELECT id, start_time,
    CASE WHEN date_sub('second', start_time, end_time) = 0 THEN {zero}
         ELSE {DIST} / ({DUR_MIN} / 60::DOUBLE) END raw_speed
  FROM {source} WHERE dayofmonth(start_time) > 10)"""


# no duration: infinite speed, or none at all without movement
_ZERO = f"(CASE WHEN {DIST} > 0 THEN 'Infinity'::DOUBLE ELSE 'NaN'::DOUBLE END)"


SQL: dict[str, str] = {
    "fastest_trips": _with(TRIPS, VENDORS, CLEAN, _speed_rows("clean")) + """
SELECT sp.id, sp.start_time, v.vendor, round(raw_speed, 6) speed_kmh
FROM sp JOIN vendors v ON v.id = sp.id ORDER BY raw_speed DESC, sp.id LIMIT 5""",
    "fastest_trips_nan_last": _with(TRIPS, VENDORS, _speed_rows("trips", _ZERO)) + """
SELECT row_number() OVER (ORDER BY CASE WHEN isnan(raw_speed) THEN NULL ELSE raw_speed END DESC NULLS LAST,
    coalesce(isnan(raw_speed), false) DESC, sp.id) "rank",
  sp.id, sp.start_time, v.vendor, round(raw_speed, 6) + 0 speed_kmh
FROM sp JOIN vendors v ON v.id = sp.id""",
    "trip_mean_duration_decimal": _with(TRIPS, CLEAN) + f"""
SELECT CAST(hour(start_time) AS INTEGER) hour_start, CAST(avg({DUR_MIN}) AS DECIMAL(32,2)) duration_min
FROM clean GROUP BY 1 ORDER BY 1""",
    "trip_mean_duration_by_hour": _with(TRIPS, CLEAN) + f"""
SELECT CAST(hour(start_time) AS INTEGER) hour_start, round(avg({DUR_MIN}), 6) duration_min
FROM clean GROUP BY 1 ORDER BY 1""",
    "mean_sum_count": _with(TRIPS, CLEAN) + """
SELECT CAST(hour(start_time) AS INTEGER) hour_start,
  CAST(sum(date_sub('second', start_time, end_time)) AS BIGINT) sum_sec, count(*) n,
  round(sum(date_sub('second', start_time, end_time)) / count(*) / 60::DOUBLE, 6) duration_min
FROM clean GROUP BY 1 ORDER BY 1""",
    "trip_max_cost_by_vendor": _with(TRIPS, VENDORS, CLEAN) + """
SELECT v.vendor, CAST(max(c.cost) AS DOUBLE) max_cost FROM clean c JOIN vendors v ON v.id = c.id
GROUP BY v.vendor ORDER BY 1""",
    "trip_clean": _with(TRIPS, CLEAN) + f"SELECT {TRIP_COLS} FROM clean",
    "trip_distance": _with(TRIPS, CLEAN) + f"SELECT id, round({DIST}, 6) distance_km FROM clean",
    "trip_duration": _with(TRIPS) + f"""
SELECT id, date_sub('second', start_time, end_time) duration_sec, round({DUR_MIN}, 6) duration_min FROM trips""",
    "trip_vendor_join": _with(TRIPS, VENDORS, CLEAN) + f"""
SELECT {_trip_cols('c')}, v.vendor FROM clean c JOIN vendors v ON v.id = c.id""",
    "limited_side_join": _with(TRIPS, VENDORS) + f"""
SELECT {_trip_cols('t')}, v.vendor
FROM trips t JOIN (SELECT * FROM vendors ORDER BY id LIMIT 100) v ON v.id = t.id""",
    "searches_per_day": _with(LOG) + """
SELECT CAST(dayofyear(date) AS INTEGER) day_of_year, count(*) searches_per_day FROM log GROUP BY 1 ORDER BY 1""",
    "searches_per_week": _with(LOG) + """
SELECT CAST(weekofyear(date) AS INTEGER) week_of_year, count(*) searches_per_week FROM log GROUP BY 1 ORDER BY 1""",
    "searches_per_month": _with(LOG) + """
SELECT CAST(month(date) AS INTEGER) month_of_year, count(*) searches_per_month FROM log GROUP BY 1 ORDER BY 1""",
    "search_success": _with(LOG) + """
SELECT count(*) total, count(pos) successes,
  round(count(pos) * 100::DOUBLE / count(*), 6) success_pct,
  round((count(*) - count(pos)) * 100::DOUBLE / count(*), 6) failure_pct
FROM log""",
    "popular_urls": _with(LOG) + """
SELECT url, count(DISTINCT userid) distinct_visitors FROM log WHERE pos IS NOT NULL
GROUP BY url HAVING count(DISTINCT userid) > 10 ORDER BY distinct_visitors DESC, url""",
    "keyword_counts": _with(TEXTS) + """
SELECT keyword, CAST(sum(n) AS BIGINT) appearances
FROM (SELECT n, unnest(string_split(keywords, ' ')) keyword FROM texts) GROUP BY keyword ORDER BY appearances DESC, keyword""",
    "distinct_keywords": _with(TEXTS) + """
SELECT count(DISTINCT keyword) distinct_keywords
FROM (SELECT unnest(string_split(keywords, ' ')) keyword FROM texts)""",
    "printable_words": _with(TITLES, WORDS) + "SELECT title_id, title FROM words",
    "title_first_letters": _with(TITLES, WORDS) + """,
letters AS (
  SELECT CASE WHEN ascii(title) BETWEEN 65 AND 90 OR ascii(title) BETWEEN 97 AND 122 THEN upper(substring(title, 1, 1))
              WHEN ascii(title) BETWEEN 48 AND 57 THEN '0Number' ELSE '!Symbol' END first_letter,
         count(*) appearances
  FROM words GROUP BY 1)
SELECT first_letter, appearances, round(appearances * 100::DOUBLE / sum(appearances) OVER (), 6) frequency
FROM letters ORDER BY first_letter""",
    "title_word_export": _with(TITLES, WORDS) + "SELECT title FROM words",
    "distinct_words": _with(TITLES, WORDS) + "SELECT DISTINCT title FROM words",
    "remove_stop_words": _with(TEXTS, STOPS, NON_STOP) + "SELECT doc_id, title FROM kw",
    "stop_words_file": _with(TEXTS, """stops AS (
  SELECT DISTINCT lower(split_part(text, ' ', 1)) stopWords FROM benchmark)""", NON_STOP) + "SELECT doc_id, title FROM kw",
    "dedup_by_key": _with(TEXTS, STOPS, NON_STOP) + """
SELECT event_id FROM events WHERE event_id % (SELECT count(*) FROM documents) IN (SELECT doc_id FROM kw)""",
    "search_title_match": _with(TEXTS, STOPS, NON_STOP, TITLES, WORDS) + """,
vocab AS (SELECT DISTINCT title FROM words),
per AS (
  SELECT kw.doc_id, max(CASE WHEN vocab.title IS NULL THEN 0 ELSE 1 END) hit, count(vocab.title) matched_words
  FROM kw LEFT JOIN vocab ON vocab.title = kw.title GROUP BY kw.doc_id)
SELECT CAST(coalesce(sum(hit * n), 0) AS BIGINT) matched, CAST(coalesce(sum(n), 0) AS BIGINT) searchable,
  round(coalesce(sum(hit * n), 0) * 100::DOUBLE / sum(n), 6) match_pct,
  CAST(coalesce(sum(matched_words * n), 0) AS BIGINT) matched_words
FROM per JOIN texts USING (doc_id)""",
    "search_row_number": _with(LOG) + """
SELECT *, row_number() OVER (ORDER BY userid, event_id) row_num FROM log""",
    "split_first": _with(SEARCHES) + """,
lines AS (SELECT event_id, concat_ws(',', CAST(event_id AS VARCHAR), userid, keywords) line FROM searches)
SELECT event_id, split_part(line, ',', 1) head,
  CASE WHEN strpos(line, ',') > 0 THEN substr(line, strpos(line, ',') + 1) END rest
FROM lines""",
    "drop_nulls": _with(LOG) + "SELECT event_id, pos, url FROM log WHERE pos IS NOT NULL AND url IS NOT NULL",
    "parse_timestamps": """
WITH t AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END ts_text
  FROM events)
SELECT event_id, ts_text, try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') parsed FROM t""",
    "repartition_join": """
SELECT o.o_orderkey k, o.o_orderpriority lv, CAST(l.l_linenumber AS VARCHAR) rv,
  concat_ws(', ', CAST(o.o_orderkey AS VARCHAR), o.o_orderpriority, CAST(l.l_linenumber AS VARCHAR)) line
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
    "broadcast_join": """
SELECT c.c_nationkey k, c.c_name lv, n.n_name rv,
  concat_ws(', ', CAST(c.c_nationkey AS VARCHAR), c.c_name, n.n_name) line
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "join_strategies": """
WITH j AS (
  SELECT count(*) n_rows, CAST(sum(o_orderkey) AS BIGINT) sum_key, CAST(sum(l_linenumber) AS BIGINT) sum_line,
    count(*) FILTER (WHERE o_orderpriority = '1-URGENT') n_urgent
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT 'auto' strategy, * FROM j UNION ALL SELECT 'broadcast', * FROM j
UNION ALL SELECT 'merge', * FROM j UNION ALL SELECT 'shuffle_hash', * FROM j""",
    "tagged_union": """
SELECT o_orderkey k, o_orderpriority v, 0 tag FROM orders
UNION ALL SELECT l_orderkey, CAST(l_linenumber AS VARCHAR), 1 FROM lineitem""",
    "parquet_scan": "SELECT * FROM lineitem",
    "parquet_convert": _with(TRIPS, VENDORS) + f"""
SELECT {_trip_cols('t')}, v.vendor FROM trips t JOIN vendors v ON v.id = t.id""",
    "csv_round_trip": _with(TRIPS) + f"SELECT {TRIP_COLS} FROM trips",
    "tsv_round_trip": _with(SEARCHES) + "SELECT userid, keywords, date, pos, url FROM searches",
    "rejected_rows": """
SELECT CAST(event_id AS VARCHAR) id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END start_time,
  date_trunc('second', ts) + INTERVAL 60 SECOND end_time, CAST(CAST(value AS FLOAT) AS DOUBLE) cost,
  event_type = 'error' is_rejected
FROM events""",
    "pair_files_join": """
SELECT concat_ws(', ', CAST(o.o_orderkey AS VARCHAR), o.o_orderpriority, CAST(l.l_linenumber AS VARCHAR)) "value"
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
    "text_line_parse": f"""
SELECT CAST(event_id AS VARCHAR) id,
  CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END start_time,
  date_trunc('second', ts) + INTERVAL 60 SECOND end_time,
  {_LON0} start_longitude, {_LAT0} start_latitude, {_LON0} end_longitude, {_LAT0} end_latitude,
  CAST(CAST(value AS FLOAT) AS DOUBLE) cost
FROM events""",
    "sql_functions": _with(TRIPS, CLEAN) + f"""
SELECT id, round({DIST}, 6) distance_km, round({DUR_MIN}, 6) duration_min FROM clean""",
    "grouped_values": _with(TRIPS, CLEAN) + """,
placed AS (
  SELECT CAST(hour(start_time) AS INTEGER) hour_start, date_sub('second', start_time, end_time) d, id,
    row_number() OVER (PARTITION BY hour(start_time) ORDER BY date_sub('second', start_time, end_time), id) - 1 pos
  FROM clean)
SELECT hour_start, pos // 100 page, count(*) n, string_agg(CAST(d AS VARCHAR), ',' ORDER BY pos) durations
FROM placed GROUP BY ALL""",
    "heavy_key_join": """
SELECT o.o_orderkey k, o.o_orderpriority lv, CAST(l.l_linenumber AS VARCHAR) rv, l.l_orderkey own
FROM orders o JOIN lineitem l ON o.o_orderkey = CASE WHEN l.l_orderkey % 3 = 0 THEN 1 ELSE l.l_orderkey END""",
    "filtered_join": """
SELECT l.l_orderkey k, CAST(l.l_linenumber AS VARCHAR) lv, o.o_orderpriority rv
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE o.o_orderpriority = '1-URGENT'""",
    "published_trips": _with(TRIPS, CLEAN) + f"SELECT {TRIP_COLS} FROM clean",
    "rejected_origins": """
SELECT CAST(event_id AS VARCHAR) id, event_id % 4 folder, line FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) line FROM events) WHERE event_type = 'error'""",
}

# States that new rows are merged into give what a whole computation gives.
SQL["merged_mean_sum_count"] = SQL["mean_sum_count"]
SQL["merged_popular_urls"] = SQL["popular_urls"]

# The same questions from a dictionary and an encoded copy of the texts.
SQL["word_dictionary"] = _with(TEXTS, TITLES) + """,
tokens AS (
  SELECT unnest(string_split(keywords, ' ')) word, 1 s FROM texts
  UNION ALL SELECT unnest(string_split(title, '_')), 0 FROM titles)
SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) id, count(*) n,
  CAST(sum(s) AS BIGINT) searches, CAST(sum(1 - s) AS BIGINT) titles
FROM tokens GROUP BY word"""
SQL["encoded_keyword_counts"] = SQL["keyword_counts"]
SQL["encoded_first_letters"] = SQL["title_first_letters"]
SQL["encoded_title_match"] = SQL["search_title_match"]
