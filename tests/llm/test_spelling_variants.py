"""Spelling variants against plain counting and all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st
from llm_cases import LOWER, no_docs, odd_docs

from quarry.llm import spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(rows):
    n = Counter()
    for i, text in rows:
        for w in RUN.findall(text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def near_pairs(words):
    """Each word with those one edit away, over the words with one code point left out."""
    known, out = set(words), {w: set() for w in words}
    holes = {}
    for w in words:
        for k in range(len(w)):
            holes.setdefault((k, w[:k], w[k + 1:]), []).append(w)
            short = w[:k] + w[k + 1:]
            if short in known:
                out[w].add(short)
                out[short].add(w)
    for some in holes.values():
        for a in some:
            out[a].update(b for b in some if b != a)
    return out


def plain(n):
    near, form = near_pairs(n), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def result(spark, docs):
    return sorted((tuple(r) for r in spelling_variants.variants(spark, docs).collect()), key=repr)


def test_whole_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = result(spark, docs)
    assert got == plain(plain_counts([(r.doc_id, r.text) for r in docs.collect()]))
    assert any(r[1] and r[2] != r[1] for r in got)  # a chain of forms


def test_odd_rows_and_no_rows(spark):
    rows = [(k, f"ÀÉÎõü àÉîõü÷ ×straße straßen STRASSE {'y' * 3000} {'y' * 2999} {'xy' * 40} {'xy' * 39}x {'xy' * 39}z naïve naive\x00naives éátude 漢字abcde", None) for k in range(4)]
    docs = odd_docs(spark).select("doc_id", "text", "row", "node").unionByName(
        spark.createDataFrame([(i, t, "w", "n") for i, t, _ in rows], "doc_id long, text string, row string, node string"))
    docs = docs.withColumnRenamed("row", "word").withColumnRenamed("node", "n")
    assert result(spark, docs) == plain(plain_counts([(r.doc_id, r.text) for r in docs.collect()]))
    assert result(spark, no_docs(spark)) == []


def test_long_lists_are_cut(spark, sf_small):
    words = spelling_variants.word_counts(spark.read.parquet(f"{sf_small}/documents.parquet")).cache()
    n = {r.word: r.n for r in words.collect()}
    near = near_pairs(n)
    got = {r.word: r.n_near for r in spelling_variants.near_words(spark, words, list_words=5, askers=11).collect()}
    assert got == {w: len(x) for w, x in near.items() if x}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abà", min_size=5, max_size=9), min_size=1, max_size=40))
def test_near_words_of_few_letters(words):
    n = {w: k + 1 for k, w in enumerate(dict.fromkeys(words))}
    rows = set()
    for w, c in n.items():
        for m in {len(w) - 1, len(w), len(w) + 1}:
            rows |= {("<" + w[:m // 2] + "|0-0", 1, w, c), (">" + w[len(w) - (m - m // 2):] + "|0-0", 1, w, c)}
        rows |= {("<" + w[:len(w) // 2] + "|0-0", 0, w, c), (">" + w[len(w) // 2:] + "|0-0", 0, w, c)}
    got: dict = {}
    for w, many, c, best in spelling_variants.near_in_lists(sorted(rows)):
        old = got.get(w, (0, (0, "")))
        got[w] = (old[0] + many, min(old[1], (-c, best)))
    near = near_pairs(n)
    assert got == {w: (len(x), min((-n[b], b) for b in x)) for w, x in near.items() if x}


def test_crc_of_runs_goes_on_from_the_document(spark):
    texts = ["abc ÉÉ x", "", "Zz"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    clean, starts, ends, rows = spelling_variants.runs(data, offsets)
    state = np.array([zlib.crc32(f"{k}:".encode()) for k in range(3)], np.uint32)
    got = spelling_variants.run_crcs(clean, starts, ends, np.repeat(state, np.diff(rows)))
    assert got.tolist() == [zlib.crc32(f"{k}:{w}".encode()) for k, w in ((0, "abc"), (0, "ÉÉ"), (0, "x"), (2, "zz"))]
