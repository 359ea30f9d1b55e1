"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import _store


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links(a, b)``: the smallest node it is connected with.

    No round follows one that leaves stars. Each round is written, so that a lost executor repeats one round; minima are taken by partial
    aggregation, so that a node with very many links is no task of its own."""
    edges = _store.written(spark, _oriented(links.select("a", "b")), "links")
    while not _settled(edges):
        # large star: the larger neighbours of a node go to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _store.written(spark, both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # the rest of the pairs: node to its smallest neighbour
        large = large.unionByName(least.where("m < a").select("a", F.col("m").alias("b")))
        edges = _store.written(spark, _oriented(large), "large-star")
        # small star: the smaller neighbours of a node, and the node, go to the smallest of them
        least = _store.written(spark, edges.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
        edges = _store.written(spark, _oriented(small), "small-star")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct pairs with the larger node first."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the pairs are stars already: a node has one smaller neighbour at most, and a node that has one is nobody's smaller neighbour."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("smaller")), F.struct(F.col("b").alias("node"), F.lit(0).alias("smaller")))
    roles = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("smaller").alias("n"), F.min("smaller").alias("least"))
    return roles.agg(F.count_if((F.col("n") > 1) | ((F.col("n") == 1) & (F.col("least") == 0)))).first()[0] == 0
