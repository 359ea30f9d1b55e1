"""Quality rules and the n-gram model (operator 5)."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from llm_cases import LOWER, WORD, no_docs, odd_docs, odd_rows
from quarry.llm import _bytes, quality_rules as qr


def base(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    times = Counter(zip(words, words[1:], words[2:]))
    marked = [False] * n
    for k in range(n - 2):
        if times[tuple(words[k:k + 3])] > 1:
            marked[k] = marked[k + 1] = marked[k + 2] = True
    repeats = sum(marked)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, repeats, n < 50 or 100 * repeats > 50 * n)


def columns(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_base_statistics_of_odd_documents(spark):
    rows = qr.score(spark, odd_docs(spark)).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, x[1:])
    assert sorted(((r.doc_id, *columns(r)) for r in rows), key=key) == sorted(((i, *base(t)) for i, t, _ in odd_rows()), key=key)
    assert all(not (r.kept and r.base_failed) for r in rows)
    assert all(r.perplexity is None for r in rows if r.n_words == 0 and r.doc_id in (1, 2))
    assert qr.score(spark, no_docs(spark)).count() == 0


def test_sample_tables(spark):
    d = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{d}/documents.parquet")
    rows = {r.doc_id: r for r in qr.score(spark, df).collect()}
    for r in df.select("doc_id", "text").collect():
        assert columns(rows[r.doc_id]) == base(r.text)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    good = [rows[i].kept for i, q in quality.items() if q == 1 and not rows[i].base_failed]
    bad = [rows[i].kept for i, q in quality.items() if q == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.4


def talk(seed, n, words=400, letters="etaoinshrdlu", language=1):
    """n words of a language in which every word has five followers."""
    r = random.Random(language)
    vocabulary = sorted({"".join(r.choice(letters) for _ in range(r.randint(2, 8))) for _ in range(words)})
    after = {w: r.sample(vocabulary, 5) for w in vocabulary}
    r = random.Random(1000 * language + seed)
    out = [r.choice(vocabulary)]
    while len(out) < n:
        out.append(r.choice(after[out[-1]]))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def fold(text):
    return int(qr.folds(*_bytes.words(*_bytes.utf8(pa.array([text])), lower=True))[0])


def plain_model(texts):
    """Interpolated modified Kneser-Ney of word pairs, by the formulas."""
    pairs, before, after = Counter(), defaultdict(set), defaultdict(list)
    for words in texts:
        pairs.update(zip(words, words[1:]))
    for b, c in pairs:
        before[c].add(b)
        after[b].append(c)
    words = {c: len(x) for c, x in before.items()}

    def discounts(counts):
        n1, n2, n3, n4 = (sum(c == k for c in counts) for k in (1, 2, 3, 4))
        if not (n1 and n2 and n3):
            return [0, 0.5, 0.75, 1.0]
        y = n1 / (n1 + 2 * n2)
        d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        return [0, *(min(max(x, 0.05), k + 1) for k, x in enumerate(d))]

    dp, dw = discounts(pairs.values()), discounts(words.values())
    total = sum(words.values())

    def p_word(c):
        if not total:
            return 1.0
        unknown = sum(dw[min(n, 3)] for n in words.values()) / total / (len(words) + 1)
        return (words[c] - dw[min(words[c], 3)]) / total + unknown if c in words else unknown

    def p(b, c):
        n = sum(pairs[b, x] for x in after[b]) if b in after else 0
        if not n:
            return p_word(c)
        weight = sum(dp[min(pairs[b, x], 3)] for x in after[b]) / n
        return (pairs[b, c] - dp[min(pairs[b, c], 3)] if (b, c) in pairs else 0) / n + weight * p_word(c)

    return p, p_word, words


def test_perplexities_by_the_formulas(spark):
    rows = [(i, t, lang) for i, t, lang in odd_rows() if len(t or "") < 50_000]
    rows += [(100 + k, " ".join(talk(k, 80)), "en") for k in range(30)] + [(200 + k, " ".join(talk(k, 70, language=2)), None) for k in range(9)]
    split = [(WORD.findall((t or "").translate(LOWER)), lang or "", fold(t or "")) for _, t, lang in rows]
    assert {f for _, _, f in split} == {0, 1}
    models = {(lang, f): plain_model([w for w, x, g in split if (x, g) == (lang, f)]) for _, lang, _ in split for f in (0, 1)}
    want = Counter()
    for (i, _, lang), (words, _, f) in zip(rows, split):
        if len(words) < 2:
            want[i, lang or "", None, None] += 1
            continue
        p, p_word, _ = models[lang or "", 1 - f]
        n = len(words) - 1
        lp = -sum(math.log(p(b, c)) for b, c in zip(words, words[1:])) / n
        want[i, lang or "", round(lp, 6), round(-sum(math.log(p_word(c)) for c in words[1:]) / n, 6)] += 1
    got = Counter((r.doc_id, r.language_model, *(None if x is None else round(math.log(x), 6) + 0.0 for x in (r.perplexity, r.words_perplexity)))
                  for r in qr.score(spark, frame(spark, rows)).collect())
    order = lambda x: str(x)
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=order), sorted(want, key=order)):
        assert a[:2] == b[:2] and got[a] == want[b]
        assert (a[2] is None) == (b[2] is None) and (a[2] is None or abs(a[2] - b[2]) < 3e-6 and abs(a[3] - b[3]) < 3e-6)


def test_probabilities_of_a_context_sum_to_one():
    p, p_word, words = plain_model([talk(k, 60) for k in range(12)])
    unknown = "not a word"
    assert math.isclose(sum(p_word(c) for c in words) + p_word(unknown), 1.0, rel_tol=1e-9)
    for b in [*list(words)[:20], unknown]:
        assert math.isclose(sum(p(b, c) for c in words) + p(b, unknown), 1.0, rel_tol=1e-9)


def test_counts_cover_every_text(spark):
    want = sum(max(0, len(WORD.findall(t or "")) - 1) for _, t, _ in odd_rows())
    docs = qr.with_key(odd_docs(spark))
    assert qr.count_pairs(docs).agg({"n": "sum"}).first()[0] == want
    assert qr.document_pairs(docs).agg({"n": "sum"}).first()[0] == want


def test_near_copies_are_mostly_in_one_fold():
    same = 0
    for k in range(200):
        words = talk(k, 100)
        same += fold(" ".join(words)) == fold(" ".join([*words[:50], "changed", *words[51:]]))
    assert same > 180
    assert 60 < sum(fold(" ".join(talk(k, 100))) for k in range(200)) < 140


def salad(seed, words):
    words = list(words)
    random.Random(seed).shuffle(words)
    return words


def test_shuffled_words_and_random_letters_are_rejected(spark):
    cyrillic = "абвгдежзиклмнопрст"
    rows = [(k, " ".join(talk(k, 150)), "en") for k in range(200)]
    rows += [(1000 + k, " ".join(salad(k, talk(500 + k, 150))), "en") for k in range(10)]
    rows += [(2000 + k, " ".join(talk(k, 150, letters=cyrillic, language=3)), "ru") for k in range(200)]
    r = random.Random(9)
    rows += [(3000 + k, " ".join("".join(r.choice(cyrillic) for _ in w) for w in talk(k, 150, letters=cyrillic, language=3)), "ru")
             for k in range(10)]
    kept = {x.doc_id: x.kept for x in qr.score(spark, frame(spark, rows)).collect()}
    for start in (0, 2000):
        assert sum(kept[start + k] for k in range(200)) >= 196
    for start in (1000, 3000):
        assert sum(kept[start + k] for k in range(10)) <= 1


def test_other_languages_change_no_verdict(spark):
    rows = [(k, " ".join(talk(k, 90, language=4)), "fr") for k in range(25)] + [(50, " ".join(salad(1, talk(77, 90, language=4))), "fr")]
    few = [(60 + k, " ".join(talk(k, 60, language=5)), "xx") for k in range(qr.LEAST_DOCUMENTS - 1)]
    more = [(1000 + k, " ".join(talk(k, 60)), "en") for k in range(60)]

    def verdicts(docs):
        return sorted((r.doc_id, r.kept, round(r.perplexity, 6)) for r in qr.score(spark, frame(spark, docs)).collect() if r.doc_id < 1000)

    alone = verdicts(rows + few)
    assert alone == verdicts(rows + few + more)
    assert all(kept for i, kept, _ in alone if i >= 60)  # too few for a band: the base rules decide


def test_pairs_are_sent_packed(spark):
    docs = qr.with_key(frame(spark, [(k, " ".join(talk(k, 300)), "en") for k in range(200)]))
    for packs in (qr.count_pairs(docs), qr.document_pairs(docs)):
        sizes = [c for c, kind in packs.dtypes if kind == "binary"]
        assert packs.selectExpr(f"sum({' + '.join(f'length({c})' for c in sizes)}) / sum(n)").first()[0] < 16  # two hashes have as many


def test_rounds_and_parts_change_no_result(spark, monkeypatch):
    rows = [(k, " ".join(talk(k, 60 + k)), "en" if k % 3 else "fr") for k in range(60)] + [(99, "", "en"), (98, None, None), (97, "one", "en")]

    def results():
        return sorted((r.doc_id, r.kept, r.perplexity and round(r.perplexity, 6), r.words_perplexity and round(r.words_perplexity, 6))
                      for r in qr.score(spark, frame(spark, rows)).collect())

    whole = results()
    monkeypatch.setattr(qr, "PART_WORDS", 150)
    grid = qr.Grid.of(sum(len((t or "").split()) for _, t, _ in rows))
    assert grid.slices == 4 and grid.rows > 4 and grid.cols > 1
    assert results() == whole


def test_grid_covers_every_size():
    for words in [*range(0, 9), 10 ** 6, 10 ** 8, 10 ** 11]:
        for grid in (qr.Grid.of(words * qr.PART_WORDS), qr.Grid.of(words)):
            assert grid.rows * grid.cols * qr.PART_WORDS >= words or words <= qr.PART_WORDS
            for g in (grid, grid.fewer()):
                assert [r for k in range(g.slices) for r in g.rows_of(k)] == list(range(g.rows))
