"""Benchmark decontamination by spaced-seed hashing.

Words are lower-cased in A-Z. Each mask of ``MASKS`` picks some positions of a
short window and ignores the others, so a window still has the same hash when
ignored words were replaced. Every window of the benchmark and of the documents
is hashed under every mask; the hashes are joined, and around each hit the two
texts are laid over each other: the longest stretch with at least ``SIMILARITY``
of its words equal counts when it has ``LEAST_WORDS`` words, or the whole
item if that is shorter. The masks catch every pattern of two replaced words in
13, three in 15 or 18, and four in 20. Items shorter than ``LEAST_WORDS`` have masks of their own length
(``short_masks``) that catch every pattern of a fifth of their words; only the lengths that occur are hashed.

A Bloom filter of the benchmark's hashes, of bounded size,
goes to the tasks, so that only windows that may hit are shuffled;
the join itself is exact, with whichever strategy Spark picks for its size.

Defined results: null and empty texts give nothing; items of fewer than ``SHORTEST`` words
are not searched (any text may hold them); very long texts are read whole; repeated items and documents are reported
by their ids, once per pair; null ids are kept as ids; an empty table on
either side gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import _bytes, _filter, _store

# Positions that count (1) in each window.
MASKS = ("111111", "101011101", "1101111", "1111011")
LEAST_WORDS = 13
SHORTEST = 3
SIMILARITY = 0.8
CONTEXT = 128  # words kept on either side of a hit

FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("doc_word", pa.int64()), ("item_word", pa.int64()),
                   ("n_words", pa.int64()), ("n_equal", pa.int64()), ("item_words", pa.int64())])


def short_masks(n: int) -> list[str]:
    """Masks for items of ``n`` < LEAST_WORDS words. A fifth of the words, r, may be replaced: positions are dealt to
    r + 2 parts, and each mask ignores r of the parts, so that any r places are ignored by one of the masks."""
    replaced = n // 5
    if not replaced:
        return ["1" * n]
    parts = replaced + 2
    return ["".join("0" if i % parts in left_out else "1" for i in range(n)) for left_out in combinations(range(parts), replaced)]


def _seeds(hashes: np.ndarray, rows: np.ndarray, lengths: list[int]):
    """For each mask, hashes of the windows that lie in one row, their first words and the first window of each row:
    ``MASKS``, then the masks of items of each of the short ``lengths``."""
    masks = [(k, m) for k, m in enumerate(MASKS)] + [(100 * n + k, m) for n in lengths for k, m in enumerate(short_masks(n))]
    for k, mask in masks:
        picked = tuple(i for i, x in enumerate(mask) if x == "1")
        h, begin, at = _bytes.windows(hashes, rows, len(mask), picked)
        yield h + np.uint64(k), begin, at


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, n_words, words as binary hashes, seeds as arrays of hash and position) of each item."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i, j, data, offsets in _bytes.row_blocks(batch.column("text")):
                hashes, rows = _bytes.words(data, offsets, lower=True)
                out = []
                for r in range(j - i):
                    own = hashes[rows[r]:rows[r + 1]]
                    found = list(_seeds(own, np.array([0, len(own)]), [len(own)] if len(own) < LEAST_WORDS else []))
                    if len(own) < LEAST_WORDS:
                        found = found[len(MASKS):] if len(own) >= SHORTEST else []
                    h = np.concatenate([np.zeros(0, np.uint64), *[h for h, _, _ in found]])
                    p = np.concatenate([np.zeros(0, np.int64), *[b for _, b, _ in found]])
                    out.append((len(own), own.tobytes(), h.view(np.int64).tolist(), p.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + j - i)), batch.column("item_id").slice(i, j - i),
                     *[pa.array([x[k] for x in out], t) for k, t in enumerate(
                         (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())))]],
                    ["item", "item_id", "n_words", "words", "hash", "at"])
                number += j - i

    return (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(seeds, "item long, item_id long, n_words long, words binary, hash array<long>, at array<long>"))


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that share a passage: the longest one."""
    items = _store.written(spark, benchmark_seeds(benchmark), "benchmark-seeds")
    seeds = items.select("item", F.explode(F.arrays_zip("hash", "at")).alias("s")).select(
        F.col("s.hash").alias("hash"), "item", F.col("s.at").alias("item_at"))
    shared = spark.sparkContext.broadcast(_filter.bloom(seeds))
    # at most LEAST_WORDS - SHORTEST rows
    lengths = sorted(r["n_words"] for r in items.where(F.col("n_words").between(SHORTEST, LEAST_WORDS - 1)).select("n_words").distinct().collect())

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for i, j, data, offsets in _bytes.row_blocks(batch.column("text")):
                hashes, rows = _bytes.words(data, offsets, lower=True)
                h, at = [], []
                for seed, begin, _ in _seeds(hashes, rows, lengths):
                    near = _filter.inside(shared.value, seed)
                    h.append(seed[near])
                    at.append(begin[near])
                h, at = np.concatenate(h), np.concatenate(at)
                order = np.argsort(at, kind="stable")
                h, at = h[order], at[order]
                row = np.searchsorted(rows, at, "right") - 1
                # hits of a row that are near each other share a region
                new = np.ones(len(at), bool)
                new[1:] = (row[1:] != row[:-1]) | (at[1:] - at[:-1] > CONTEXT)
                first = np.flatnonzero(new)
                for a, b in zip(first, np.append(first[1:], len(at))):
                    r = row[a]
                    s = max(rows[r], at[a] - CONTEXT)
                    e = min(rows[r + 1], at[b - 1] + CONTEXT)
                    out.append((number, batch.column("doc_id")[i + int(r)].as_py(), int(s - rows[r]), hashes[s:e].tobytes(),
                                h[a:b].view(np.int64).tolist(), (at[a:b] - s).tolist()))
                    number += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in out], t) for k, t in enumerate(
                        (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                    ["region", "doc_id", "start", "words", "hash", "at"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    regions = _store.written(spark, source.mapInArrow(
        hits, "region long, doc_id long, start long, words binary, hash array<long>, at array<long>"), "seed-hits")
    # where one text is laid over the other: a row per region and item, with at most as many shifts as both have words
    laid = (regions.select("region", F.explode(F.arrays_zip("hash", "at")).alias("s"))
            .select("region", F.col("s.hash").alias("hash"), F.col("s.at").alias("at"))
            .join(seeds, "hash").groupBy("region", "item").agg(F.collect_set(F.col("at") - F.col("item_at")).alias("shifts")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    doc, item = np.frombuffer(r["words"], np.uint64), np.frombuffer(r["item_words"], np.uint64)
                    found = longest_overlap(doc, item, r["shifts"])
                    if found and found[0] >= min(LEAST_WORDS, len(item)):
                        yield (r["doc_id"], r["item_id"], r["start"] - found[2], -found[3], found[0], found[1], len(item))

        yield from _store.batches(rows(), FOUND)

    found = (laid.join(regions.select("region", "doc_id", "start", "words"), "region")
             .join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
             .mapInArrow(verify, "doc_id long, item_id long, doc_word long, item_word long, n_words long, n_equal long, item_words long"))
    best = F.max(F.struct("n_words", "n_equal", (-F.col("doc_word")).alias("d"), (-F.col("item_word")).alias("i"), "item_words"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", (-F.col("b.d")).alias("doc_word"), (-F.col("b.i")).alias("item_word"), "b.n_words", "b.n_equal",
        "b.item_words", (F.col("b.n_equal") / F.col("b.n_words")).alias("similarity"))


def longest_overlap(doc: np.ndarray, item: np.ndarray, shifts: list[int]) -> tuple[int, int, int, int] | None:
    """(words, equal words, -first word of doc, -first word of item) of the longest stretch under any shift (then
    of most equal words, then the first)."""
    best = None
    for shift in sorted(shifts):
        a, b = max(0, shift), min(len(doc), len(item) + shift)
        s, e, n = longest_stretch(doc[a:b] == item[a - shift:b - shift])
        one = (e - s, n, -(a + s), -(a + s - shift))
        best = one if best is None else max(best, one)
        if best[1] == len(item):
            break  # the whole item, word for word: other places come later in the text
    return best


def longest_stretch(equal: np.ndarray, share: float = SIMILARITY) -> tuple[int, int, int]:
    """Start, end and number of equal words of the longest stretch of which ``share`` is equal (the first such)."""
    n = len(equal)
    if not n:
        return 0, 0, 0
    # whole numbers: each equal word weighs 1 - share, each other one -share, times 1000
    sums = np.zeros(n + 1, np.int64)
    np.cumsum(np.where(equal, round(1000 * (1 - share)), -round(1000 * share)), out=sums[1:])
    best_after = np.maximum.accumulate(sums[::-1])[::-1]  # falling: the last place that still reaches a sum
    ends = n - np.searchsorted(best_after[::-1], sums, "left")
    s = int(np.argmax(ends - np.arange(n + 1)))
    e = int(ends[s])
    return s, e, int(equal[s:e].sum())


def drop_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that share no passage with the benchmark, in all their columns."""
    # a row is named by a hash of its id and text, so that rows without an id are told apart
    name = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    named = find_leaks(spark, docs.select(name.alias("doc_id"), "text"), benchmark)
    leak = _store.spare(docs, "leaked")
    leaked = _store.written(spark, named.select(F.col("doc_id").alias(leak)).distinct(), "leaked")
    return docs.join(leaked, name == F.col(leak), "left_anti")
