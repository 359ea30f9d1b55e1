"""Suffix-array dedup (operator 4)."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from llm_cases import no_docs, odd_docs, odd_rows, prose
from quarry.llm import suffix_dedup as sd

N = sd.LENGTH


def brute(docs):
    """(n_bytes, n_removed, n_spans, sha256) of each text."""
    raw = [(t or "").encode() for _, t, *_ in docs]
    times = Counter(hash(t[i:i + N]) for t in raw for i in range(len(t) - N + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - N + 1):
            if times[hash(t[i:i + N])] > 1:
                gone[i:i + N] = True
        gone = gone[:len(t)]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def check(spark, docs, df):
    rows = sd.remove_repeats(spark, df).collect()
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    want = sorted((d[0] is not None, d[0] or 0, *b) for d, b in zip(docs, brute(docs)))
    assert got == want
    for r in rows:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
    return rows


def test_interval_expansion_against_counting():
    rng = np.random.default_rng(1)
    for _ in range(150):
        length = int(rng.integers(9, 40))
        pool = [rng.integers(0, int(rng.choice([1, 2, 4, 30])), int(rng.integers(5, 120))).astype(np.uint8) for _ in range(4)]
        parts = [np.concatenate([pool[k] for k in rng.integers(0, 4, rng.integers(1, 5))]) for _ in range(rng.integers(1, 8))]
        times = Counter(bytes(p[i:i + length]) for p in parts for i in range(len(p) - length + 1))
        got = sd.repeated_starts(np.concatenate([np.append(p.astype(np.uint16) + 1, 0) for p in parts]), length, 8)
        k = 0
        for p in parts:
            want = [times[bytes(p[i:i + length])] > 1 for i in range(len(p) - length + 1)]
            assert got[k:k + len(want)].tolist() == want
            k += len(p) + 1


def test_runs_cover_every_window_once_and_depend_on_it_alone():
    texts = [prose(1, 400).encode(), b"", b"x" * 399, b"y" * 400, b"ab" * 500, prose(1, 400).encode()[37:1500]]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    row, start, many, anchor, _ = sd.anchored_runs(data, offsets)
    anchors = {}
    seen = Counter()
    for r, s, m, a in zip(row.tolist(), start.tolist(), many.tolist(), anchor.tolist()):
        for i in range(s, s + m):
            seen[r, i] += 1
            assert anchors.setdefault(texts[r][i:i + N], a) == a
    assert seen == Counter((r, i) for r, t in enumerate(texts) for i in range(len(t) - N + 1))


@pytest.mark.parametrize("group", [sd.GROUP_CONTEXTS, 1])
def test_odd_documents(spark, monkeypatch, group):
    monkeypatch.setattr(sd, "GROUP_CONTEXTS", group)  # 1: every unsure group is dealt by window hashes
    docs = [d for d in odd_rows() if d[0] not in (9, 10)]
    assert any(r.n_removed for r in check(spark, docs, odd_docs(spark).where("doc_id IS NULL OR doc_id NOT IN (9, 10)")))


@pytest.mark.parametrize("group", [sd.GROUP_CONTEXTS, 1])
def test_shared_passages_in_many_documents(spark, monkeypatch, group):
    monkeypatch.setattr(sd, "GROUP_CONTEXTS", group)
    passage, other = prose(900, 110), prose(901, 90)
    docs = [(k, f"{prose(k, 40)} {passage if k % 3 else passage[:350]} {prose(500 + k, 30)}{other if k % 4 == 0 else ''}", "en")
            for k in range(40)] + [(100, other + prose(7, 60) + other, "en"), (101, passage[100:] + other[:300], "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    check(spark, docs, df)


def test_empty_table(spark):
    assert sd.remove_repeats(spark, no_docs(spark)).count() == 0


def test_sample_tables(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    check(spark, docs, df)
