"""Benchmark decontamination by spaced seeds (operator 2)."""

import itertools
import random

import numpy as np
import pyarrow as pa

from llm_cases import no_docs, odd_docs, prose
from quarry.llm import _bytes, _filter, decontamination as dc


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "item_id long, text string, region string, hash string")


def passage(seed, n):
    return " ".join(prose(1000 + seed, n).split())


def test_planted_passages_are_found_and_clean_documents_are_not(spark):
    bench = [(k, passage(k, 40)) for k in range(12)]
    r = random.Random(4)
    docs, want = [], {}
    for k, t in bench:
        words = t.split()
        docs.append((100 + k, f"{prose(k, 200)}\n{t}\n{prose(50 + k, 100)}"))
        want[(100 + k, k)] = (40, 40)
        changed = list(words)
        for at in r.sample(range(40), 6):
            changed[at] = "other"
        docs.append((200 + k, f"{prose(70 + k, 30)} {' '.join(changed).upper()} {prose(90 + k, 30)}"))
        want[(200 + k, k)] = None
        docs.append((300 + k, f"{prose(110 + k, 30)} {' '.join(words[10:26])} {prose(130 + k, 30)}"))
        want[(300 + k, k)] = (16, 16)
        docs.append((400 + k, f"{prose(150 + k, 300)} {' '.join(words[5:12])} {prose(170 + k, 100)}"))  # too short
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {(x.doc_id, x.item_id): x for x in dc.find_leaks(spark, df, items(spark, bench)).collect()}
    assert set(found) == set(want)
    for key, exact in want.items():
        x = found[key]
        assert x.similarity >= 0.8 and x.n_words >= 13 and x.item_words == 40
        if exact:
            assert (x.n_words >= exact[0]) and x.n_equal >= exact[1]


def test_masks_catch_substitutions():
    for n, changed in ((13, 2), (15, 3), (18, 3)):
        for places in itertools.combinations(range(n), changed):
            assert any(all(at + i not in places for i, x in enumerate(m) if x == "1")
                       for m in dc.MASKS for at in range(n - len(m) + 1))


def test_short_masks_catch_all_patterns():
    for n in range(dc.SHORTEST, dc.LEAST_WORDS):
        masks = dc.short_masks(n)
        assert all(len(m) == n and m.count("1") >= 3 for m in masks)
        for places in itertools.combinations(range(n), n // 5):
            assert any(all(m[i] == "0" for i in places) for m in masks)


def test_all_patterns_in_short_items_are_found(spark):
    """Items of 3 to 12 words with every choice of a fifth of the words replaced; one more is too many."""
    bench = [(n, " ".join(f"w{n}x{i}" for i in range(n))) for n in range(1, 13)]
    docs, want = [], set()
    for n, text in bench:
        for places in itertools.combinations(range(n), n // 5):
            words = ["other" if i in places else w for i, w in enumerate(text.split())]
            docs.append((len(docs), f"{prose(len(docs), 20)} {' '.join(words)} {prose(len(docs), 9)}"))
            if n >= dc.SHORTEST:
                want.add((docs[-1][0], n, n, n - n // 5))
        words = ["other" if i <= n // 5 else w for i, w in enumerate(text.split())]
        docs.append((len(docs), f"{prose(len(docs), 20)} {' '.join(words)} {prose(len(docs), 9)}"))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r.doc_id, r.item_id, r.n_words, r.n_equal) for r in dc.find_leaks(spark, df, items(spark, bench)).collect()} == want


def test_overlap_against_every_shift():
    r = np.random.default_rng(5)
    for _ in range(200):
        doc, item = r.integers(0, 2, r.integers(1, 30)).astype(np.uint64), r.integers(0, 2, r.integers(1, 9)).astype(np.uint64)
        shifts = list(range(-len(item) + 1, len(doc)))
        found = []
        for k in shifts:
            a, b = max(0, k), min(len(doc), len(item) + k)
            s, e, n = dc.longest_stretch(doc[a:b] == item[a - k:b - k])
            found.append((e - s, n, -(a + s), -(a + s - k)))
        assert dc.longest_overlap(doc, item, shifts) == max(found)


def test_a_long_text_of_equal_words(spark):
    docs = spark.createDataFrame([(1, "again " * 20_000), (2, prose(1, 20_000))], "doc_id long, text string")
    rows = dc.find_leaks(spark, docs, items(spark, [(1, "again " * 40), (2, "again " * 4)])).collect()
    assert sorted((r.doc_id, r.item_id, r.doc_word, r.n_equal) for r in rows) == [(1, 1, 0, 40), (1, 2, 0, 4)]


def test_longest_stretch_against_all_stretches():
    r = np.random.default_rng(2)
    for _ in range(300):
        e = r.random(r.integers(0, 40)) < r.random()
        s, t, n = dc.longest_stretch(e)
        best = max((b - a for a in range(len(e) + 1) for b in range(a, len(e) + 1) if 10 * e[a:b].sum() >= 8 * (b - a)), default=0)
        assert t - s == best and n == e[s:t].sum() and 10 * n >= 8 * (t - s)


def test_bloom_lets_all_members_through(spark):
    h = spark.range(5000).selectExpr("xxhash64(id) AS hash")
    f = _filter.bloom(h)
    members = np.array([r[0] for r in h.collect()], np.int64).view(np.uint64)
    assert len(_filter.inside(f, members)) == 5000
    others = np.array([r[0] for r in spark.range(10 ** 6, 10 ** 6 + 20000).selectExpr("xxhash64(id)").collect()], np.int64).view(np.uint64)
    assert len(_filter.inside(f, others)) < 100


def test_odd_rows(spark):
    bench = [(1, None), (2, ""), (3, "two words"), (None, prose(5, 200)), (4, prose(3, 120)), (4, prose(3, 120)), (5, "one two three four five six")]
    rows = dc.find_leaks(spark, odd_docs(spark), items(spark, bench)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.item_id) for r in rows if r.item_id is not None) == [(True, 0, 4)]
    assert {r.doc_id for r in rows if r.item_id is None} == {-16}
    assert dc.find_leaks(spark, no_docs(spark), items(spark, bench)).count() == 0
    assert dc.find_leaks(spark, odd_docs(spark), items(spark, [])).count() == 0
    kept = dc.drop_leaks(spark, odd_docs(spark), items(spark, bench))
    assert kept.columns == odd_docs(spark).columns and kept.count() == odd_docs(spark).count() - 2


def test_sample_tables_against_plain_search(spark):
    d = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in dc.find_leaks(spark, docs, bench).collect()}
    texts, its = docs.select("doc_id", "text").collect(), bench.collect()
    whole = {(t.doc_id, b.item_id) for t in texts for b in its if b.text in t.text}
    assert whole and whole <= found
    # whatever else was found does hold a stretch of that similarity
    low = lambda s: _bytes.words(*_bytes.utf8(pa.array([s])), lower=True)[0]
    by_doc, by_item = {t.doc_id: t.text for t in texts}, {b.item_id: b.text for b in its}
    for doc, item in found - whole:
        x, y = low(by_doc[doc]), low(by_item[item])
        best = 0
        for shift in range(-len(y) + 1, len(x)):
            a, b = max(0, shift), min(len(x), len(y) + shift)
            s, e, _ = dc.longest_stretch(x[a:b] == y[a - shift:b - shift])
            best = max(best, e - s)
        assert best >= min(13, len(y))
