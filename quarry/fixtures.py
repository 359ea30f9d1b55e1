"""Job inputs derived from the test tables (``events``, ``documents``).

The trip, vendor, search-log, title and stop-word inputs have no counterpart
among the test tables, so they are derived from them: projections of
``events`` and ``documents``, and for the search log one join of events with
the whole document texts.  The same derivations are written in DuckDB SQL for the
oracle (``quarry.plans.oracle``).  Every derived row comes from a table row,
so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The stop words of the derived search log (test fixture).
FIXTURE_STOP_WORDS = ["the", "and", "of", "that", "in", "is"]

_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; one DataFrame per application and path, so the file listing and
    footer read happen once, not once per query (the tables are read-only)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


_LON0 = "(-80.5D + (event_id * 37 % 1100) / 100D)"
_LAT0 = "(39.5D + (event_id * 53 % 700) / 100D)"


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips from events: about 11% non-positive durations, 1% equal endpoints, some outside the box, and a
    few without movement or time (no speed)."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS id",
        "ts AS start_time",
        "CASE WHEN event_id % 388 = 0 THEN ts"
        " ELSE timestampadd(SECOND, CAST(floor(value * 10) AS INT) - 60, ts) END AS end_time",
        f"{_LON0} AS start_longitude",
        f"{_LAT0} AS start_latitude",
        f"CASE WHEN event_id % 97 = 0 THEN {_LON0} ELSE -80.5D + (event_id * 71 % 1100) / 100D END AS end_longitude",
        f"CASE WHEN event_id % 97 = 0 THEN {_LAT0} ELSE 39.5D + (event_id * 91 % 700) / 100D END AS end_latitude",
        "CAST(value AS FLOAT) AS cost",
    )


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor per trip id; error events have none (the inner join drops them)."""
    return table(spark, sf_dir, "events").where("event_type <> 'error'").selectExpr(
        "CAST(event_id AS STRING) AS id", "CAST(user_id % 3 + 1 AS STRING) AS vendor")


_OK = "event_type IN ('click', 'view', 'purchase')"


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search log from events without the keywords: one row per search, dates spread over about five years.

    ``event_id`` is the natural row key (no global ``row_number``).
    """
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CAST(user_id AS STRING) AS userid",
        "timestampadd(DAY, CAST(event_id % 2000 AS INT), ts) AS date",
        f"CASE WHEN {_OK} THEN CAST(event_id % 10 + 1 AS INT) END AS pos",
        f"CASE WHEN {_OK} THEN concat('http://site', CAST(event_id * 7 % 40 AS STRING), '.example/') END AS url",
    )


def _with_doc_id(spark: SparkSession, sf_dir: str, searches: DataFrame) -> DataFrame:
    """The document whose text a search has as keywords: ``event_id % n_documents``
    (the document count is a scalar subquery, not a cross join)."""
    n_docs = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    return searches.withColumn("doc_id", F.col("event_id") % n_docs)


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole search log: the keywords of a search are the whole text of its document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("keywords"))
    return _with_doc_id(spark, sf_dir, search_log(spark, sf_dir)).join(docs, "doc_id").select(
        "event_id", "userid", "keywords", "date", "pos", "url")


def search_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each searched text once: ``doc_id, keywords, n`` with the number of its searches, so that a text is
    split once and not once per search."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("keywords"))
    counts = search_ids(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return docs.join(counts, "doc_id")


def search_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, doc_id`` of every search."""
    return _with_doc_id(spark, sf_dir, table(spark, sf_dir, "events").select("event_id"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles from all documents: the whole text with ``_`` for spaces; ``title_id`` is the document id."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("title_id"), F.replace("text", F.lit(" "), F.lit("_")).alias("title"))


def stop_words(spark: SparkSession) -> DataFrame:
    """The fixture's stop-word list as column ``stopWords``.

    Built from a one-row range so the planner knows it is tiny and broadcasts
    it into the anti join (a frame made from a Python list has no size
    statistics and would be planned as a sort-merge join).
    """
    words = F.array(*[F.lit(w) for w in FIXTURE_STOP_WORDS])
    return spark.range(0, 1, 1, numPartitions=1).select(F.explode(words).alias("stopWords"))


def order_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join side ``k, v`` from orders (key ``o_orderkey``)."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("v"))


def lineitem_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join side ``k, v`` from lineitem (key ``l_orderkey``)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("string").alias("v"))


def customer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join side ``k, v`` from customer (key ``c_nationkey``)."""
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_name").alias("v"))


def nation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join side ``k, v`` from nation (key ``n_nationkey``)."""
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"))
