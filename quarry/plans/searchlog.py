"""Search-log profile: calendar counts, success ratio, popular URLs, keywords,
title first letters, title-word export and the share of searches that match a title.

Row identity is a natural key column (``event_id`` by default); no global
window is used to number rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from quarry.config import JobParams, scratch_dir
from quarry.functions.text import first_letter_class, is_printable_word, split_words
from quarry.operators.dictionary import COMMON_BYTES, COMMON_WORDS
from quarry.operators.joins import hinted
from quarry.operators.ordering import top_k
from quarry.operators.state import advance, distinct_counts, distinct_state, grown_dictionary, merge_distinct
from quarry.sources.publish import current_version, publish, published
from quarry.sources.writers import write_delimited, write_parquet

_CALENDAR = {
    "day": (F.dayofyear, "day_of_year", "searches_per_day"),
    "week": (F.weekofyear, "week_of_year", "searches_per_week"),
    "month": (F.month, "month_of_year", "searches_per_month"),
}


def calendar_counts(searches: DataFrame, unit: str, by_year: bool = False) -> DataFrame:
    """Searches per day of year, ISO week or month, ordered by that key.

    Like the original job the year is not part of the key unless ``by_year``;
    ISO weeks are then keyed by their ISO week-year (2006-01-01 is week 52 of 2005).
    """
    fn, key, name = _CALENDAR[unit]
    keys = [fn("date").alias(key)]
    if by_year:
        year = F.expr("extract(YEAROFWEEK FROM date)") if unit == "week" else F.year("date")
        keys = [year.alias("year")] + keys
    out = searches.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(*[k for k in (["year"] if by_year else [])], key)


def success_ratio(searches: DataFrame) -> DataFrame:
    """Total searches, successful ones (a click position) and both percentages, in one pass."""
    agg = searches.agg(F.count(F.lit(1)).alias("total"), F.count("pos").alias("successes"))
    return agg.select(
        "total", "successes",
        F.try_divide(F.col("successes") * F.lit(100.0), F.col("total")).alias("success_pct"),
        F.try_divide((F.col("total") - F.col("successes")) * F.lit(100.0), F.col("total")).alias("failure_pct"),
    )


def popular_urls(searches: DataFrame, p: JobParams = JobParams()) -> DataFrame:
    """URLs of successful searches with more than ``popular_min_visitors`` distinct users, most first; ``popular_top`` (default none) keeps the first.

    ``countDistinct`` is planned in two aggregation steps keyed first by
    ``(url, userid)`` then by ``url``: duplicates are removed map-side and a
    very popular URL is spread over tasks by user before its final count.
    """
    counts = (
        searches.filter(F.col("pos").isNotNull())
        .groupBy("url")
        .agg(F.countDistinct("userid").alias("distinct_visitors"))
        .filter(F.col("distinct_visitors") > p.popular_min_visitors)
    )
    return ranked(counts, p.popular_top, [F.col("distinct_visitors").desc(), F.col("url")])


def ranked(df: DataFrame, top: int | None, order: list) -> DataFrame:
    return df.orderBy(*order) if top is None else top_k(df, top, order)


def keyword_rows(searches: DataFrame, weight: str | None = None) -> DataFrame:
    """One row per space-separated keyword token (empty tokens kept), with the weight of its search."""
    extra = [weight] if weight else []
    return searches.select(*extra, F.explode(split_words("keywords", " ")).alias("keyword"))


def keyword_counts(searches: DataFrame, top: int | None = None, weight: str | None = None) -> DataFrame:
    """Appearances per keyword, most frequent first (ties by keyword); ``top=None`` keeps all.

    ``weight`` names a column with the number of searches that a row stands for: a text that
    many searches share is then split once.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = keyword_rows(searches, weight).groupBy("keyword").agg(n.alias("appearances"))
    return ranked(counts, top, [F.col("appearances").desc(), F.col("keyword")])


def distinct_keywords(searches: DataFrame) -> DataFrame:
    """Number of distinct keyword tokens."""
    return keyword_rows(searches).agg(F.countDistinct("keyword").alias("distinct_keywords"))


def title_words(titles: DataFrame) -> DataFrame:
    """Printable words of the titles (split on ``_``), with their position.

    Output ``title`` (the word), ``pos`` and ``title_id`` when the titles carry one.
    """
    keep = ["title_id"] if "title_id" in titles.columns else []
    words = titles.select(*keep, F.posexplode(split_words("title", "_")).alias("pos", "word"))
    return words.filter(is_printable_word("word")).select(*keep, "pos", F.col("word").alias("title"))


def title_first_letters(titles: DataFrame) -> DataFrame:
    """Histogram of the first character class of title words, with percentages.

    After the aggregation at most 28 rows remain (26 letters, numbers,
    symbols), so the total over the whole table is a window over a bounded
    input.
    """
    return letter_shares(title_words(titles), "title", F.count(F.lit(1)))


def letter_shares(words: DataFrame, word: str, n: Column) -> DataFrame:
    """``first_letter, appearances, frequency`` of words; the aggregate ``n`` counts them."""
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        words.groupBy(first_letter_class(word).alias("first_letter"))
        .agg(n.alias("appearances"))
        .withColumn("frequency", F.col("appearances") * F.lit(100.0) / F.sum("appearances").over(whole))
        .orderBy("first_letter")
    )


def export_title_words(titles: DataFrame, path: str, p: JobParams = JobParams(), mode: str = "errorifexists") -> str:
    """Write the title words sorted, in ``export_files`` tab-separated files with a header (escaped form).

    Files hold consecutive word ranges, each sorted; the title id and word
    position break ties at file boundaries so one frequent word can span
    several files.
    """
    if "title_id" not in titles.columns:
        # a key per title line from its position in the input split: deterministic
        # when ``titles`` is a file scan (as read by ``read_titles``), and it also
        # separates identical copies of a frequent title
        titles = titles.withColumn("title_id", F.monotonically_increasing_id())
    words = title_words(titles)
    return write_delimited(words, path, sep="\t", header=True, mode=mode, num_files=p.export_files,
                           sort_by=["title"], tie_break=["title_id", "pos"], columns=["title"], escaped=True)


def search_words(searches: DataFrame, id_col: str = "event_id") -> DataFrame:
    """Printable keyword tokens per search: ``id_col, title`` (the column name of the title words)."""
    return (
        searches.select(id_col, F.explode(split_words("keywords", " ")).alias("title"))
        .filter(is_printable_word("title"))
    )


def remove_stop_words(words: DataFrame, stops: DataFrame, word_col: str = "title",
                      strategy: str = "broadcast", stops_bounded: bool = False,
                      fold_case: bool = False) -> DataFrame:
    """Anti join: drop rows whose word is a stop word (case-sensitive).

    A stop list is small, so by default it is broadcast once its size is
    proven (``fits_broadcast``), or at once when ``stops_bounded`` says it is
    a literal list; the hint holds even when the session disables automatic
    broadcasts, and a list beyond the bound falls back to a sort-merge anti join.
    Matching is case-sensitive like the original job; ``fold_case`` compares
    lower-cased words instead.
    """
    stop = F.lower("stopWords") if fold_case else F.col("stopWords")
    word = F.lower(F.col(word_col)) if fold_case else F.col(word_col)
    s = hinted(stops.select(stop.alias("stopWords")), strategy, bounded=stops_bounded)
    return words.join(s, word == F.col("stopWords"), "left_anti")


def distinct_title_words(titles: DataFrame) -> DataFrame:
    """Distinct printable title words (column ``title``)."""
    return title_words(titles).select("title").distinct()


def search_title_match(searches: DataFrame, titles: DataFrame, stops: DataFrame, id_col: str = "event_id",
                       strategy: str = "auto", stops_bounded: bool = False, weight: str | None = None) -> DataFrame:
    """Share of searches with a non-stop keyword that equals some title word.

    Output ``matched``, ``searchable`` (searches with at least one printable
    non-stop keyword), ``match_pct`` and ``matched_words`` (their keyword tokens that are title words).
    The most frequent title words (a fixed number, of bounded length) are broadcast, so tokens of them only count where
    they are read, and no hot title word is left for the join; the others meet the title vocabulary.  Rows are summed up by search
    alone, so no task holds a map of searches and words.  ``weight`` names a column with the number of searches that a row stands for.
    """
    spark = titles.sparkSession
    vocab = title_words(titles).groupBy("title").agg(F.count(F.lit(1)).alias("n"))
    vocab = spark.read.parquet(write_parquet(vocab, scratch_dir(spark, "title-vocabulary")))
    common = top_k(vocab.where(F.octet_length("title") <= COMMON_BYTES), COMMON_WORDS, [F.col("n").desc(), F.col("title")])
    words = remove_stop_words(search_words(searches, id_col), stops, stops_bounded=stops_bounded)
    words = words.join(F.broadcast(common.select(F.col("title").alias("known"))), F.col("title") == F.col("known"), "left")
    # a row per token; a common word is known to match and left out (null)
    words = words.select(id_col, F.when(F.col("known").isNull(), F.col("title")).alias("title"))
    words = spark.read.parquet(write_parquet(words, scratch_dir(spark, "search-words")))
    others = words.where("title IS NOT NULL").join(hinted(vocab.select("title", F.lit(1).alias("hit")), strategy), "title", "left")
    per_search = (
        words.where("title IS NULL").withColumn("hit", F.lit(1)).unionByName(others)
        .groupBy(id_col)
        .agg(F.coalesce(F.max("hit"), F.lit(0)).alias("hit"), F.count("hit").alias("words"))
    )
    n = F.lit(1)
    if weight:
        per_search, n = per_search.join(searches.select(id_col, weight), id_col), F.col(weight)
    return match_shares(per_search, n)


def match_shares(per_search: DataFrame, n: Column) -> DataFrame:
    """The shares of :func:`search_title_match` from ``hit`` and ``words`` of each search; ``n`` is the number it stands for."""
    return per_search.agg(
        F.coalesce(F.sum(F.col("hit") * n), F.lit(0)).cast("long").alias("matched"),
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("searchable"),
        F.coalesce(F.sum(F.col("words") * n), F.lit(0)).cast("long").alias("matched_words"),
    ).select("matched", "searchable",
             F.try_divide(F.col("matched") * F.lit(100.0), F.col("searchable")).alias("match_pct"), "matched_words")


def advance_visitors(spark: SparkSession, base: str, new_log: DataFrame) -> None:
    """Merge new rows of the log into the published visitor state at ``base``: a dictionary of users, and a
    bitmap of user ids per clicked URL. Rows merged earlier are not read again; rows merged twice change nothing."""
    clicked = new_log.filter(F.col("pos").isNotNull()).select("url", "userid")
    users = f"{base}/users"
    version = current_version(spark, users)
    publish(grown_dictionary(published(spark, users, version) if version else None, clicked, "userid"), users, expected=version)
    advance(spark, f"{base}/visitors", distinct_state(clicked, "url", "userid", published(spark, users)),
            lambda a, b: merge_distinct(a, b, "url"))


def popular_urls_from_state(spark: SparkSession, base: str, p: JobParams = JobParams()) -> DataFrame:
    """:func:`popular_urls` from the published visitor state."""
    counts = distinct_counts(published(spark, f"{base}/visitors"), "url", "distinct_visitors").filter(
        F.col("distinct_visitors") > p.popular_min_visitors)
    return ranked(counts, p.popular_top, [F.col("distinct_visitors").desc(), F.col("url")])
