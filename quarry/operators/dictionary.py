"""Word dictionary: words numbered by falling frequency, texts encoded once as the numbers of their words.

A few words make up most of every text. The most frequent ones (a fixed number, of bounded length) are broadcast
to the texts, so their rows are encoded where they are read; only rows of other words are shuffled
to the rest of the dictionary. A word that a third of all rows hold is one of the former, and no hot key is left for the join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.ranges import row_number_by_ranges

# Common words: at most this many, each of at most this many bytes, so a broadcast of them has at most 8 MB of words.
COMMON_WORDS = 65_536
COMMON_BYTES = 128


def write_dictionary(spark: SparkSession, sources: dict[str, DataFrame], path: str, word: str = "word",
                     common_words: int = COMMON_WORDS) -> DataFrame:
    """Write and return ``word, id, n, common`` and one column per source: how often its rows hold the word.

    ``sources`` maps a column name to a frame with the column ``word``, a row per token. Null tokens are left out, empty ones are
    words. Ids run from 1 without gaps, by falling ``n`` (appearances in all sources), ties by word. ``path`` must not exist.
    """
    tokens = None
    for name, df in sources.items():
        part = df.select(F.col(word).alias("word"), F.lit(name).alias("source")).where(F.col("word").isNotNull())
        tokens = part if tokens is None else tokens.unionByName(part)
    counts = tokens.groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("source") == name).alias(name) for name in sources])
    # the ranges read the counts more than once
    counts.withColumn("rarity", -F.col("n")).write.parquet(f"{path}/counts")
    numbered = row_number_by_ranges(spark.read.parquet(f"{path}/counts"), ["rarity", "word"], "id")
    common = (F.col("id") <= common_words) & (F.octet_length("word") <= COMMON_BYTES)
    numbered.select("word", "id", "n", common.alias("common"), *sources).write.parquet(f"{path}/words")
    return spark.read.parquet(f"{path}/words")


@dataclass(frozen=True)
class Encoded:
    """Encoded tokens in two parts, the rows of common words and all others: the columns of the rows, and ``word_id``."""

    common: DataFrame
    rare: DataFrame

    def rows(self) -> DataFrame:
        return self.common.unionByName(self.rare)

    def with_words(self, words: DataFrame) -> DataFrame:
        """Inner join of the tokens with rows of the dictionary (or fewer columns of it, ``id`` and ``common`` among them)."""
        return self.common.join(F.broadcast(words.where("common")), F.col("word_id") == F.col("id")).unionByName(
            self.rare.join(words.where("NOT common"), F.col("word_id") == F.col("id")))

    def totals(self, words: DataFrame, weight: str | None = None, name: str = "appearances") -> DataFrame:
        """``words`` with the number of tokens, or the sum of the column ``weight`` over them; words without tokens are left out."""
        n = F.sum(weight) if weight else F.count(F.lit(1))
        folded = Encoded(*[part.groupBy("word_id").agg(n.alias(name)) for part in (self.common, self.rare)])
        return folded.with_words(words).drop("word_id")


def encode(spark: SparkSession, tokens: DataFrame, dictionary: DataFrame, path: str, word: str = "word") -> Encoded:
    """Write the tokens with the id of their word in the place of the column ``word``, and return what was written.

    One row per token; a token that the dictionary does not hold (or a null one) has a null id and is kept, in ``rare``. ``path``
    must not exist; ``tokens`` must not have columns ``word_id`` and ``rest`` of their own.
    """
    keep = [c for c in tokens.columns if c != word]
    if clash := {"word_id", "rest"} & {c.lower() for c in keep}:
        raise ValueError(f"columns of these names are written here: {sorted(clash)}")
    known = dictionary.select(F.col("word").alias("known"), F.col("id").alias("word_id"), "common")
    marked = tokens.join(F.broadcast(known.where("common")), F.col(word) == F.col("known"), "left").select(
        *keep, "word_id", F.when(F.col("word_id").isNull(), F.struct(F.col(word).alias("word"))).alias("rest"))
    marked.write.parquet(f"{path}/marked")
    marked = spark.read.parquet(f"{path}/marked")
    rest = marked.where("word_id IS NULL").drop("word_id")
    rest.join(known.where("NOT common"), F.col("rest.word") == F.col("known"), "left").select(*keep, "word_id").write.parquet(f"{path}/rare")
    return Encoded(marked.where("word_id IS NOT NULL").drop("rest"), spark.read.parquet(f"{path}/rare"))
