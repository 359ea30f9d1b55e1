"""N-gram Jaccard join by parity sketches (operator 9)."""

import random

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import LOWER, WORD, no_docs, odd_docs, odd_rows, prose
from quarry.llm import _bytes, _components, jaccard_join as jj


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(docs):
    """(n_shingles, component) of each document by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and None not in (docs[a][0], docs[b][0]):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return [(i, len(s), least.get(top(k)) if i is not None else None) for k, ((i, _), s) in enumerate(zip(docs, sets))]


def check(spark, docs, df):
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in jj.similar_components(spark, df).collect()]
    assert sorted(rows, key=repr) == sorted(brute(docs), key=repr)


def test_odd_documents(spark):
    check(spark, [(i, t) for i, t, _ in odd_rows()], odd_docs(spark))
    assert jj.similar_components(spark, no_docs(spark)).count() == 0


def families(seed, n_families, size):
    """Chains of edited copies around the threshold, short and long."""
    r = random.Random(seed)
    docs = []
    for f in range(n_families):
        words = prose(seed * 1000 + f, r.choice([6, 9, 14, 30, 60, 150, 400])).split()
        for _ in range(size):
            docs.append((len(docs) * 3 % 1009 + len(docs), " ".join(words)))
            words = list(words)
            for _ in range(max(1, round(len(words) * r.choice([0.005, 0.01, 0.02, 0.04])))):
                words[r.randrange(len(words))] = f"w{r.randrange(10 ** 6)}"
            if r.random() < 0.3:
                words = words[r.randrange(3):]
    return docs


@pytest.mark.parametrize("blocks", [(4096, 4_000_000), (3, 4_000_000), (4096, 500)])
def test_chains_of_edited_copies(spark, monkeypatch, blocks):
    monkeypatch.setattr(jj, "BLOCK_NODES", blocks[0])  # small: families are cut, blocks compared in pairs
    monkeypatch.setattr(jj, "BLOCK_HASHES", blocks[1])
    docs = families(1, 30, 8)
    check(spark, docs, spark.createDataFrame(docs, "doc_id long, text string").repartition(6))


def test_cut_families_are_not_copied_for_each_pair_of_blocks(spark, monkeypatch):
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[k:], r.integers(0, 1 << 63, k + 1, dtype=np.uint64)])) for k in range(60)]
    rows = [(k, len(h), h.tobytes()) for k, h in enumerate(sets)] + [(100, 1, sets[0][:1].tobytes())]
    df = spark.createDataFrame(rows, "node long, n long, hashes binary").repartition(4)
    monkeypatch.setattr(jj, "BLOCK_NODES", 3)  # 20 blocks, 210 pairs
    monkeypatch.setattr(jj, "MOST_TASKS", 8, raising=False)

    def on_disk():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(k).length() for k in range(files.size()))

    before = on_disk()
    links = jj.similar_links(spark, df)
    assert on_disk() - before < 12 * sum(len(x[2]) for x in rows)  # all steps; copies for each pair alone are 20
    assert {(x.node, x.component) for x in _components.components(spark, links).collect()} == {(k, 0) for k in range(60)}


def test_keep_one_of_each_group(spark):
    docs = odd_docs(spark)
    kept = jj.keep_one(spark, docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    assert ids.count(6) == 1 and 7 not in ids and 8 not in ids and 14 not in ids
    assert {1, 2, 3, 4, 5, 9, 11, 12, 13, 15, 17} <= set(ids)
    assert sum(r.doc_id is None for r in kept.collect()) == 2


def test_similar_sets_share_a_block_key():
    r = np.random.default_rng(4)
    all_bands = jj.bands(5000)
    for _ in range(400):
        n = int(r.choice([1, 2, 3, 4, 5, 7, 10, 20, 40, 100, 400, 1500]))
        a = r.integers(0, 1 << 63, n, dtype=np.uint64)
        gone = r.integers(0, n // 5 + 1)
        more = r.integers(0, n // 4 + 1)
        b = np.concatenate([a[gone:], r.integers(0, 1 << 63, more, dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert np.intersect1d(jj.block_keys(a, all_bands), jj.block_keys(b, all_bands)).size


def test_sketch_distance_bounds_the_difference():
    r = np.random.default_rng(6)
    sets = [np.unique(r.integers(0, 3000, r.integers(1, 900)).astype(np.uint64)) for _ in range(40)]
    s = jj.sketches(sets)
    for x in range(40):
        for y in range(40):
            assert np.bitwise_count(s[x] ^ s[y]).sum() <= len(np.setxor1d(sets[x], sets[y]))


def test_spanning_links_connect_what_all_pairs_connect():
    r = np.random.default_rng(8)
    for _ in range(60):
        base = np.unique(r.integers(0, 1 << 63, 40, dtype=np.uint64))
        sets = []
        for _ in range(12):
            keep = base[r.random(len(base)) > r.choice([0.02, 0.1, 0.2])]
            sets.append(np.unique(np.concatenate([keep, r.integers(0, 1 << 63, r.integers(0, 4), dtype=np.uint64)])))
        def groups(pairs):
            root = list(range(12))
            for a, b in pairs:
                old, new = root[a], root[b]
                root = [new if x == old else x for x in root]
            return {frozenset(i for i in range(12) if root[i] == x) for x in root}
        want = [(a, b) for a in range(12) for b in range(a) if jj.similar(sets[a], sets[b])]
        got = jj.spanning_links(sets)
        assert all(jj.similar(sets[a], sets[b]) for a, b in got) and groups(got) == groups(want)
        side = r.integers(0, 2, 12)
        assert groups(jj.spanning_links(sets, side)) == groups([(a, b) for a, b in want if side[a] != side[b]])


def test_components_of_chains_and_stars(spark):
    pairs = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 300), (300, 200)]
    df = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    got = {r.node: r.component for r in _components.components(spark, df).collect()}
    want = {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 140)} | {200: 200, 300: 200}
    assert got == want
    assert _components.components(spark, df.limit(0)).count() == 0


def test_shingle_sets_by_row():
    texts = [t for _, t, _ in odd_rows()]
    hashes, at = jj.shingle_sets(*_bytes.utf8(pa.array(texts)))
    assert np.diff(at).tolist() == [len(shingles(t)) for t in texts]
    prints = jj.fingerprints(hashes, at)
    for a in range(len(texts)):
        for b in range(a):
            assert (prints[a] == prints[b]) == (shingles(texts[a]) == shingles(texts[b]))


def test_sample_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(spark, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], df)
