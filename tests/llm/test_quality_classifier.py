"""Positive-unlabelled quality classifier (operator 3)."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm_cases import no_docs, odd_docs
from quarry.llm import _bytes, quality_classifier as qc

SF = "/root/testdata/sf0.1"


def auc(good, bad):
    good, bad = np.array(good), np.array(bad)
    return float(((good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()))


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = qc.score(spark, docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert auc([r.score for r in held if r.quality == 1], [r.score for r in held if r.quality == 0]) > 0.97
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_labels_of_held_out_rows_and_negatives_are_not_used(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    other = labels.withColumn("quality", F.when(qc.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    masked = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("?"))
    a = {r.doc_id: r.score for r in qc.score(spark, docs, labels).collect()}
    b = {r.doc_id: r.score for r in qc.score(spark, masked, other).collect()}
    assert a == b


def test_prior_and_risk_on_synthetic_data():
    r = np.random.default_rng(5)
    shape = (2000, qc.N_FEATURES)
    good, bad = r.normal(0.5, 1, shape), r.normal(-0.5, 1, shape)
    for share in (0.3, 0.8):
        k = int(4000 * share)
        mixed = np.vstack([r.normal(0.5, 1, (k, shape[1])), r.normal(-0.5, 1, (4000 - k, shape[1]))])
        r.shuffle(mixed)
        net, prior = qc.fit(good, mixed)
        assert abs(prior - share) < 0.12
        assert (net.score(r.normal(0.5, 1, shape)) > 0.5).mean() > 0.95 and (net.score(bad) < 0.5).mean() > 0.9


def test_features_do_not_depend_on_the_block():
    texts = ["One two three.\nFOUR five!!", "", "é ü", "a a a a\na a a a", "x | y | z"]
    data, offsets = _bytes.utf8(pa.array(texts))
    together = qc.features(data, offsets)
    assert together.shape == (5, qc.N_FEATURES)
    for k, t in enumerate(texts):
        assert np.array_equal(together[k], qc.features(*_bytes.utf8(pa.array([t])))[0])


def test_odd_rows(spark):
    labels = spark.createDataFrame([(6, 1, 0), (7, 1, 0), (7, 0, 0), (8, None, 0), (None, 1, 0), (999, 1, 1), (9, 1, 0), (12, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = odd_docs(spark)
    rows = qc.score(spark, docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    kept = qc.keep_good(spark, docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in rows)
    assert all(r.score == 0.5 and r.predicted == 0 for r in qc.score(spark, docs, labels.limit(0)).collect())
    assert qc.score(spark, no_docs(spark), labels).count() == 0
