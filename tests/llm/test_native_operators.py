"""Chat formatting (6), license scan (8) and line dedup (10) against DuckDB and plain Python."""

import re

import pytest

from conftest import plan_text
from llm_cases import best_labels, own_word, no_docs, odd_docs, odd_rows
from oracle_check import compare, duck
from quarry.llm import chat_formatting as cf, license_scan as ls, line_dedup as ld, queries


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_query_matches_sql(spark, key, sf):
    d = f"/root/testdata/{sf}"
    ok, why = compare(spark, duck(d), key, queries.QUERIES[key], queries.SQL[key], d)
    assert ok, why


@pytest.mark.parametrize("key", ["op6_chat_formatting", "op8_license_scan", "op10_line_dedup"])
def test_no_python_in_the_plan(spark, sf_small, key):
    plan = plan_text(queries.QUERIES[key](spark, sf_small))
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


def test_preference_pairs(spark):
    u, a, s = "user", "assistant", "system"
    turns = [
        (0, 0, s, "be kind"), (0, 1, u, "hi"), (0, 2, a, "hello"), (1, 0, s, "be kind"), (1, 1, u, "hi"), (1, 2, a, "go away"), (1, 3, u, None),
        (2, 0, u, "same"), (2, 1, a, "same"), (3, 1, a, "same"), (3, 0, u, "same"),
        (4, 0, u, "x"), (5, 0, u, "x"), (5, 1, a, "y"),
        (6, 0, None, "no role"), (6, 0, None, "no role"),
        (9, 0, u, "alone"), (None, 0, u, "lost"),
    ]
    df = spark.createDataFrame([(*t, 1, 2) for t in turns], "conv_id long, turn long, role string, text string, pair_id int, c int")
    rows = {r.pair_id: r for r in cf.format_preferences(cf.adjacent_pairs(df)).collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4]
    r = rows[0]
    assert (r.status, r.n_prompt_turns, r.n_chosen_turns, r.n_rejected_turns) == ("pair", 2, 1, 2)
    assert r.prompt == "<|system|>\nbe kind<|end|>\n<|user|>\nhi<|end|>\n"
    assert r.chosen == "<|assistant|>\nhello<|end|>\n" and r.chosen_mask == "14:0,13:1"
    assert r.rejected == "<|assistant|>\ngo away<|end|>\n<|user|>\n<|end|>\n" and r.rejected_mask == "14:0,15:1,9:0,8:0"
    assert rows[1].status == "identical" and rows[1].chosen == rows[1].rejected == "" and rows[1].n_prompt_turns == 2
    assert rows[2].status == "prefix" and rows[2].rejected_mask == "14:0,9:1"
    assert rows[3].status == "unpaired" and rows[3].n_chosen_turns == 2
    assert rows[4].status == "unpaired" and rows[4].chosen == "" and rows[4].rejected.startswith("<|user|>\nalone")
    for x in rows.values():
        for text, mask in ((x.chosen, x.chosen_mask), (x.rejected, x.rejected_mask)):
            assert sum(int(part.split(":")[0]) for part in mask.split(",") if part) == len(text)
    assert cf.format_preferences(cf.adjacent_pairs(df.limit(0))).count() == 0


def license_rows(text):
    """The scan in plain Python, without filters."""
    t = (text or "").translate(str.maketrans(ls.UPPER, ls.LOWER))
    words = re.findall(ls.WORD, t)
    places, labels = [], set()
    for phrase, label in ls.BASE:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    found, best, shares = set(labels), 0.0, {}
    for line in t.split("\n"):
        block = set(re.findall(ls.WORD, line))
        for k, (_, template) in enumerate(ls.TEMPLATES):
            ws = ls.template_words(template)
            share = len(block & set(ws)) / len(ws)
            if share >= ls.THRESHOLD - 1e-12 and own_word(block, k, ls.TEMPLATES):
                shares[k] = max(share, shares.get(k, 0))
                best = max(best, share)
    found |= best_labels(shares, ls.TEMPLATES)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
            ",".join(sorted(found)), max(best, 1.0 if places else 0.0))


def test_license_scan_of_odd_documents(spark):
    more = [(50, "MIT\nlicense and Apache LICENSE, mit license"), (51, "licensed cc by 4 0 NC under"), (52, "apache licenses"),
            (53, "This Source Code Form is subject to the terms of the Mozilla Public License v. 2.0."),
            (54, "the gnu general public license\nGENERAL public license"), (55, "Lİcense mıt license MİT license")]
    docs = [(i, t) for i, t, _ in odd_rows()] + more
    df = odd_docs(spark).select("doc_id", "text", "row", "label").unionByName(
        spark.createDataFrame([(i, t, "r", "l") for i, t in more], "doc_id long, text string, row string, label string"))
    rows = ls.scan(spark, df).collect()
    key = lambda x: repr(x)
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in rows), key=key)
    assert got == sorted(((i, *license_rows(t)) for i, t in docs), key=key)
    assert ls.scan(spark, no_docs(spark)).count() == 0


def deduped(docs):
    """Later copies of every run of lines, however long, in plain Python; documents in order."""
    seen, out = set(), []
    lines = [(t or "").split("\n") for t in docs]
    gone = [set() for _ in docs]
    for k, ls_ in enumerate(lines):
        words = [len(re.findall(ld.WORD, x)) for x in ls_]
        for i in range(len(ls_)):
            total = 0
            for j in range(i, len(ls_) if words[i] else i):
                total += words[j]
                if total >= ld.RUN_WORDS and words[j]:
                    run = hash(tuple(ls_[i:j + 1]))
                    if run in seen:
                        gone[k] |= set(range(i, j + 1))
                    seen.add(run)
    for t, ls_, g in zip(docs, lines, gone):
        out.append((len(ls_), len(g), sum(i - 1 not in g for i in g),
                    None if t is None else "\n".join(x for i, x in enumerate(ls_) if i not in g)))
    return out


def test_line_dedup_of_odd_documents(spark):
    # equal ids follow each other in the order of their rows: one partition keeps it
    docs = sorted(((i, t) for i, t, _ in odd_rows() if (t or "").count("\n") < 400), key=lambda x: (x[0] is not None, x[0] or 0))
    df = odd_docs(spark).coalesce(1).where("text IS NULL OR length(text) - length(replace(text, '\n', '')) < 400")
    rows = ld.dedup_lines(spark, df).collect()
    key = lambda x: repr(x)
    want = [(i, *x) for (i, _), x in zip(docs, deduped([t for _, t in docs]))]
    got = [(r.doc_id, r.n_lines, r.n_removed, r.n_runs, r.text) for r in rows]
    # rows without an id are ties, and only one of them has lines
    assert sorted(got, key=key) == sorted(want, key=key)
    assert ld.dedup_lines(spark, no_docs(spark)).count() == 0


def test_dropped_lines_keep_all_columns(spark):
    kept = ld.drop_lines(spark, odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    rows = kept.collect()
    assert [r.n_chars for r in rows] == [None if r.text is None else len(r.text) for r in rows]
    # texts that were empty before stay; a copy of which nothing is left goes
    assert {1, 2, 3, 4} <= {r.doc_id for r in rows}
    assert sum(r.doc_id in (6, 7) for r in rows) == 1
    assert ld.drop_lines(spark, no_docs(spark)).count() == 0


@pytest.mark.parametrize("n", [1, 3, 4, 5, 9])
def test_runs_of_short_lines(spark, n):
    run = [f"l{i}" for i in range(n)]
    docs = [(k, "\n".join([f"a{k}", *run, f"b{k}", *run[:3]])) for k in range(5)]
    rows = ld.dedup_lines(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    want = deduped([t for _, t in docs])
    assert [(r.n_lines, r.n_removed, r.n_runs, r.text) for r in sorted(rows, key=lambda r: r.doc_id)] == want
