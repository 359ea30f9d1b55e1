"""Quality classifier: positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are documents labelled 1; everything else is unlabelled web
text. The class prior is estimated by the best bin of a first classifier
of positives against unlabelled text: the smallest ratio, over score
thresholds, of the share of unlabelled to the share of positive rows above it. Then a small network
minimises ``prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)])`` with
the logistic loss, whose minimiser is the log odds of label 1; a step
in which the second term falls below zero climbs on that term instead.

Training uses a bounded sample (``MOST_POSITIVE`` and ``MOST_UNLABELLED`` rows,
those with the smallest hashes of doc_id), never a row held out by
``crc32(doc_id as text) % 4 = 2``; scoring covers every whole text. Features are
shares of character classes and of repeated words and lines; no
label, language, source or id is among them.

Defined results: null text counts as empty and is scored as such; a document
with several label rows is a trusted positive when all of them say 1; null
doc_id is scored and not held out; repeated rows are scored each; without
positives or unlabelled rows the score is the prior 0.5; very long texts are scored
whole; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.llm import _bytes
from quarry.llm._classes import CLASSES, classes
from quarry.llm.quality_rules import statistics

MOST_POSITIVE = 10_000
MOST_UNLABELLED = 20_000
THRESHOLD = 0.7
HELD_OUT_FOLD, FOLDS = 2, 4
HIDDEN = 32
STEPS = 600
RATE = 0.01
DECAY = 1e-4

MARKS = b"!|#*$%&<>"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features per text of a block."""
    n_rows = len(offsets) - 1
    c, rows = classes(data, offsets)
    chars = np.diff(rows)
    some = np.maximum(chars, 1)
    row_of = np.repeat(np.arange(n_rows), chars)
    share = np.bincount(row_of * CLASSES + c, minlength=n_rows * CLASSES).reshape(n_rows, CLASSES) / some[:, None]
    parts = [np.sqrt(share)]
    for mark in MARKS:
        seen = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data == mark, out=seen[1:])
        parts.append(np.sqrt(np.diff(seen[offsets]) / some)[:, None])
    n_words, word_chars, _, dups, repeats = statistics(data, offsets)
    words = np.maximum(n_words, 1)
    hashes, at = _bytes.words(data, offsets)
    word_row = np.repeat(np.arange(n_rows), n_words)
    distinct = _bytes.mix(hashes + _bytes.mix(word_row.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(distinct, return_index=True)
    kinds = np.bincount(word_row[first], minlength=n_rows)
    same = np.zeros(len(hashes), np.int64)
    same[1:] = distinct[1:] == distinct[:-1]
    echoes = np.bincount(word_row, same, minlength=n_rows) if len(hashes) else np.zeros(n_rows)
    lines = np.maximum(share[:, 1] * chars, 1)
    parts += [x[:, None] for x in (
        np.sqrt(repeats / words), np.sqrt(dups / lines).clip(0, 1), kinds / words, np.sqrt(echoes / words),
        word_chars / words / 10, np.log1p(n_words) / 10, (n_words < 50) * 1.0)]
    return np.hstack(parts).astype(np.float32)


N_FEATURES = CLASSES + len(MARKS) + 7


class Network:
    """One hidden layer and a linear path, fitted with Adam."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.Generator(np.random.PCG64(7))
        n = len(mean)
        self.mean, self.scale = mean, scale
        self.w = [rng.normal(0, n ** -0.5, (n, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN),
                  np.zeros(n), np.zeros(1)]

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale).clip(-8, 8)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(x @ self.w[0] + self.w[1], 0)
        return h @ self.w[2] + x @ self.w[3] + self.w[4][0], h

    def gradient(self, x: np.ndarray, h: np.ndarray, g: np.ndarray) -> list[np.ndarray]:
        back = np.outer(g, self.w[2]) * (h > 0)
        return [x.T @ back, back.sum(0), h.T @ g, x.T @ g, g.sum(keepdims=True)]

    def fit(self, x: np.ndarray, slopes) -> "Network":
        """``slopes`` gives the derivative of the risk by each row's output."""
        m, v = [0.0] * 5, [0.0] * 5
        for t in range(1, STEPS + 1):
            f, h = self.forward(x)
            grad = self.gradient(x, h, slopes(f))
            for k, g in enumerate(grad):
                g = g + DECAY * self.w[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.w[k] = self.w[k] - RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.forward(self.inputs(x))[0])


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f, -40, 40)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Best-bin estimate of the share of positives in the unlabelled rows, from scores of both."""
    cuts = np.unique(np.quantile(positive, np.linspace(0, 0.98, 99)))
    above_p = (positive[:, None] >= cuts).mean(0)
    above_u = (unlabelled[:, None] >= cuts).mean(0)
    slack = np.sqrt(np.log(200) / 2 / len(unlabelled)) + np.sqrt(np.log(200) / 2 / len(positive))
    best = np.argmin((above_u + slack) / np.maximum(above_p, 1e-9))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[Network | None, float]:
    """The network and the estimated prior."""
    n_p, n_u = len(positive), len(unlabelled)
    if not n_p or not n_u:
        return None, 0.5
    both = np.vstack([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(0), both.std(0) + 1e-3
    x = ((both - mean) / scale).clip(-8, 8)

    def against_unlabelled(f):
        s = _sigmoid(f)
        return np.concatenate([(s[:n_p] - 1) / n_p, s[n_p:] / n_u])

    # two halves, so that the prior is read from rows the first classifier did not see
    half_p, half_u = n_p // 2, n_u // 2
    if half_p and half_u:
        part = np.r_[0:half_p, n_p:n_p + half_u]

        def halves(f):
            s = _sigmoid(f)
            return np.concatenate([(s[:half_p] - 1) / half_p, s[half_p:] / half_u])

        first = Network(mean, scale).fit(x[part], halves)
        f = first.forward(x)[0]
        prior = class_prior(f[half_p:n_p], f[n_p + half_u:])
    else:
        prior = 0.5

    def non_negative(f):
        s = _sigmoid(f)
        loss = np.logaddexp(0, f)  # of label 0
        negative = loss[n_p:].mean() - prior * loss[:n_p].mean()
        on_p, on_u = -prior * s[:n_p] / n_p, s[n_p:] / n_u
        if negative < 0:
            return np.concatenate([-on_p, -on_u])
        return np.concatenate([prior * (s[:n_p] - 1) / n_p + on_p, on_u])

    return Network(mean, scale).fit(x, non_negative), prior


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features of the sampled positives and unlabelled rows (at most MOST_POSITIVE and MOST_UNLABELLED)."""
    order = (F.xxhash64("doc_id"), "doc_id")
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    trusted = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
               .where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
               .groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q")).where("q = 1").select("doc_id"))
    picked = (trusted.join(usable, "doc_id", "left_semi").orderBy(*order).limit(MOST_POSITIVE).withColumn("positive", F.lit(True))
              .unionByName(usable.orderBy(*order).limit(MOST_UNLABELLED).withColumn("positive", F.lit(False))))
    # both parts are bounded by parameters
    picked = picked.groupBy("doc_id").agg(F.max("positive").alias("positive"), F.min("positive").alias("only_positive"))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(picked), "doc_id").select("doc_id", "positive", "only_positive", "text"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in _bytes.row_blocks(batch.column("text")):
                x = features(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(i, j - i) for k in range(3)), pa.array([r.tobytes() for r in x], pa.binary())],
                    ["doc_id", "positive", "only_positive", "x"])

    got = (rows.mapInArrow(featured, "doc_id long, positive boolean, only_positive boolean, x binary")
           .dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id"))
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, N_FEATURES)
    positive = got.column("positive").to_numpy(zero_copy_only=False).astype(bool)
    only = got.column("only_positive").to_numpy(zero_copy_only=False).astype(bool)
    # a fixed order that has nothing to do with ids
    order = np.random.Generator(np.random.PCG64(11)).permutation(len(x))
    return x[order][positive[order]], x[order][~only[order]]


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    network, prior = fit(*training_sample(docs, labels))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in _bytes.row_blocks(batch.column("text")):
                s = network.score(features(data, offsets)) if network else np.full(j - i, prior)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(s, pa.float64())],
                                                 ["doc_id", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(scored, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score of at least THRESHOLD, in all their columns."""
    network, prior = fit(*training_sample(docs, labels))

    def scores(texts):
        s = np.empty(len(texts))
        for i, j, data, offsets in _bytes.row_blocks(texts):
            s[i:j] = network.score(features(data, offsets)) if network else prior
        return pa.array(s >= THRESHOLD)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(scores(batch.column("text")))

    return docs.mapInArrow(kept, docs.schema)
