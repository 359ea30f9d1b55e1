"""The word questions of the search log, answered from a dictionary and one encoded copy of the searched texts.

The dictionary counts every word in searches and in titles, so the histogram of titles and their vocabulary are read
off it; counts of keywords and the share of matching searches read the encoded copy, in which no text is split again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import is_printable_word, split_words
from quarry.operators.dictionary import COMMON_WORDS, Encoded, encode, write_dictionary
from quarry.plans import searchlog


@dataclass(frozen=True)
class WordIndex:
    """``dictionary`` with the counts ``searches`` and ``titles``, and the encoded tokens of the searches."""

    dictionary: DataFrame
    searches: Encoded
    id_col: str
    weight: str | None


def write_word_index(spark: SparkSession, searches: DataFrame, titles: DataFrame, path: str, id_col: str = "event_id",
                     weight: str | None = None, common_words: int = COMMON_WORDS) -> WordIndex:
    """Write the dictionary of both and the encoded searches under ``path``, which must not exist.

    ``weight`` names a column with the number of searches that a row stands for.
    """
    extra = [weight] if weight else []
    tokens = searches.select(id_col, *extra, F.explode(split_words("keywords", " ")).alias("word"))
    sources = {"searches": tokens, "titles": titles.select(F.explode(split_words("title", "_")).alias("word"))}
    dictionary = write_dictionary(spark, sources, f"{path}/dictionary", common_words=common_words)
    return WordIndex(dictionary, encode(spark, tokens, dictionary, f"{path}/searches"), id_col, weight)


def keyword_counts(index: WordIndex, top: int | None = None) -> DataFrame:
    """:func:`searchlog.keyword_counts` from the encoded copy: ids are summed up, and words looked up for the sums."""
    words = index.dictionary.select("id", "common", F.col("word").alias("keyword"))
    counts = index.searches.totals(words, index.weight).select("keyword", "appearances")
    return searchlog.ranked(counts, top, [F.col("appearances").desc(), F.col("keyword")])


def title_first_letters(index: WordIndex) -> DataFrame:
    """:func:`searchlog.title_first_letters` from the dictionary: a row per word, not per token."""
    words = index.dictionary.where((F.col("titles") > 0) & is_printable_word("word"))
    return searchlog.letter_shares(words, "word", F.sum("titles"))


def search_title_match(index: WordIndex, stops: DataFrame, stops_bounded: bool = False) -> DataFrame:
    """:func:`searchlog.search_title_match` from both: stop words leave the dictionary, and tokens meet what is left of it.

    Tokens of a search are folded before they are shuffled: a row per search and task.
    """
    words = searchlog.remove_stop_words(index.dictionary.where(is_printable_word("word")), stops, "word", stops_bounded=stops_bounded)
    words = words.select("id", "common", (F.col("titles") > 0).cast("int").alias("hit"))
    n = F.max(index.weight) if index.weight else F.lit(1)
    per_search = index.searches.with_words(words).groupBy(index.id_col).agg(
        F.max("hit").alias("hit"), F.sum("hit").alias("words"), n.alias("stands_for"))
    return searchlog.match_shares(per_search, F.col("stands_for"))
