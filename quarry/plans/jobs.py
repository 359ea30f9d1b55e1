"""Whole jobs over files, with the inputs and switches of the original programs.

Each job reads its inputs with declared schemas and returns lazily built
DataFrames (or the paths it wrote); nothing is shown or collected.  Caching is
the caller's choice: wrap the actions in ``quarry.operators.persisted``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quarry.config import JobParams
from quarry.operators.cleaning import clean_trips
from quarry.operators.joins import broadcast_join, format_pairs, join, limited_side_join, repartition_join
from quarry.plans import searchlog, trips
from quarry.sources.readers import read_pairs, read_searches, read_stop_words, read_titles, read_trips, read_vendors
from quarry.sources.writers import write_parquet, write_text


@dataclass(frozen=True)
class TripAnswers:
    mean_duration_by_hour: DataFrame
    max_cost_by_vendor: DataFrame
    fastest_trips: DataFrame


def trip_questions(spark: SparkSession, trips_path: str, vendors_path: str, fmt: str = "csv",
                   p: JobParams = JobParams(), strategy: str = "auto", as_decimal: bool = True,
                   stage_dir: str | None = None) -> TripAnswers:
    """The three trip questions over CSV (declared schema), Parquet or catalog-table (``fmt="table"``) inputs.

    With ``stage_dir`` (a shared folder) the inputs are parsed and the trips cleaned once, and written there
    as Parquet; every answer reads its columns from that copy, which survives executor loss.
    """
    t = read_trips(spark, trips_path, fmt)
    v = read_vendors(spark, vendors_path, fmt)
    if stage_dir:
        base = stage_dir.rstrip("/")
        t = spark.read.parquet(write_parquet(clean_trips(t, p), f"{base}/clean_trips.parquet"))
        v = spark.read.parquet(write_parquet(v, f"{base}/vendors.parquet"))
    return TripAnswers(
        trips.mean_duration_by_hour(t, p, as_decimal=as_decimal),
        trips.max_cost_by_vendor(t, v, p, strategy),
        trips.fastest_trips(t, v, p, strategy),
    )


def trip_vendor_sample_join(spark: SparkSession, trips_parquet: str, vendors_parquet: str, n: int = 100,
                            strategy: str | None = None) -> DataFrame:
    """Trips joined with the first ``n`` vendors by id (the join-strategy job).

    Without ``strategy`` the limited side is broadcast (its size is bounded by
    ``n``); with a strategy the caller forces ``merge``, ``shuffle_hash`` or a
    checked ``broadcast``.  Inspect the choice with ``explain("formatted")``.
    """
    t = read_trips(spark, trips_parquet, "parquet")
    v = read_vendors(spark, vendors_parquet, "parquet")
    if strategy is None:
        return limited_side_join(t, v, "id", n, "id")
    return join(t, v.orderBy("id").limit(n), "id", strategy=strategy)


@dataclass(frozen=True)
class SearchProfile:
    searches_per_day: DataFrame
    searches_per_week: DataFrame
    searches_per_month: DataFrame
    success: DataFrame
    popular_urls: DataFrame
    keyword_counts: DataFrame
    distinct_keywords: DataFrame
    title_first_letters: DataFrame
    title_match: DataFrame


def search_profile(spark: SparkSession, log_path: str, titles_path: str, stops_path: str,
                   p: JobParams = JobParams(), stops_header: bool = False, id_col: str | None = None,
                   multi_line: bool = False, escaped: bool = False, stage_dir: str | None = None) -> SearchProfile:
    """The search-log questions over a TSV log (with header), a titles CSV and a stop-word list.

    The log needs a unique row key for the title match: ``id_col`` names it;
    without one, a key is derived from each row's position in its input file
    split (stable across recomputation of the file scan).  ``multi_line``
    accepts quoted fields with line breaks (such files are not split); ``escaped`` reads the
    backslash form of ``write_delimited``.

    The nine answers each scan the log.  With ``stage_dir`` (a shared folder)
    the log and titles are parsed once and written there as Parquet; every
    answer then reads only its columns from that copy instead of re-parsing
    the text, and the copy survives executor loss, unlike a cache.
    """
    from pyspark.sql import functions as F

    log = read_searches(spark, log_path, multi_line=multi_line, escaped=escaped)
    if id_col is None:
        id_col = "row_key"
        log = log.withColumn(id_col, F.monotonically_increasing_id())
    titles = read_titles(spark, titles_path, multi_line=multi_line, escaped=escaped)
    if stage_dir:
        base = stage_dir.rstrip("/")
        log = spark.read.parquet(write_parquet(log, f"{base}/searches.parquet"))
        titles = spark.read.parquet(write_parquet(titles, f"{base}/titles.parquet"))
    stops = read_stop_words(spark, stops_path, header=stops_header)
    return SearchProfile(
        searchlog.calendar_counts(log, "day"),
        searchlog.calendar_counts(log, "week"),
        searchlog.calendar_counts(log, "month"),
        searchlog.success_ratio(log),
        searchlog.popular_urls(log, p),
        searchlog.keyword_counts(log, p.keyword_top),
        searchlog.distinct_keywords(log),
        searchlog.title_first_letters(titles),
        searchlog.search_title_match(log, titles, stops, id_col=id_col),
    )


def export_titles(spark: SparkSession, titles_path: str, out_path: str, p: JobParams = JobParams(),
                  mode: str = "errorifexists", multi_line: bool = False) -> str:
    """Write the printable title words sorted into TSV files with a header (``export_files`` of them, if given)."""
    return searchlog.export_title_words(read_titles(spark, titles_path, multi_line), out_path, p, mode)


def pair_joins(spark: SparkSession, left_path: str, right_path: str, out_dir: str | None = None,
               sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    """Repartition join and broadcast join of two key/value files (first two fields of each line).

    With ``out_dir`` both results are also written as ``k, lv, rv`` text lines
    (overwriting) under ``out_dir/repartition`` and ``out_dir/broadcast``.
    """
    left, right = read_pairs(spark, left_path, sep), read_pairs(spark, right_path, sep)
    rep, bc = repartition_join(left, right), broadcast_join(left, right)
    if out_dir:
        write_text(format_pairs(rep), f"{out_dir.rstrip('/')}/repartition")
        write_text(format_pairs(bc), f"{out_dir.rstrip('/')}/broadcast")
    return rep, bc
