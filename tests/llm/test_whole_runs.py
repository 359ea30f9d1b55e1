"""Whole repeated runs of lines (10), in the pipeline's stage and the operator."""

import random
import re

import corpus_pipeline
from quarry.llm import line_dedup as ld

WORDS = re.compile(ld.WORD)


def dropped(spark, texts):
    df = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    rows = corpus_pipeline.lines(spark, df.repartition(3), "").collect()
    return {r.doc_id: r.text for r in rows}


def plain(texts):
    """Every later copy of every run, however long, in plain Python."""
    seen, out = set(), {}
    lines = [t.split("\n") for t in texts]
    gone = [set() for _ in texts]
    for k, ls in enumerate(lines):
        for i in range(len(ls)):
            for j in range(i + 1, len(ls) + 1):
                run = tuple(ls[i:j])
                counts = [len(WORDS.findall(x)) for x in run]
                worded = sum(counts) >= ld.RUN_WORDS and counts[0] and counts[-1]
                if worded and run in seen:
                    gone[k] |= set(range(i, j))
                seen.add(run)
    for k, ls in enumerate(lines):
        text = "\n".join(x for i, x in enumerate(ls) if i not in gone[k])
        if not gone[k] or text.replace("\n", "").strip(" "):
            out[k] = text
    return out


def test_runs_of_two_and_three_lines(spark):
    pair = "Erreth was ofretihaou the that edouhe.\nOf, edti oner."
    three = "one two\n\nthree four five\nsix seven eight"
    tabs = "a\tb\tc\td\te\tf\tg\th"
    few = "two words\nonly here"
    texts = [f"x{k}\n{pair}\ny{k}\n{three}\nz{k}\n{tabs}\nw{k}\n{few}\nv{k}" for k in range(4)]
    got = dropped(spark, texts)
    assert got[0] == texts[0]
    assert [got[k] for k in (1, 2, 3)] == [f"x{k}\ny{k}\nz{k}\nw{k}\n{few}\nv{k}" for k in (1, 2, 3)]


def test_against_all_runs(spark):
    r = random.Random(7)
    pool = ["", "", " ", "\t", "a b", "c", "d e f", "g h i j", "k l m n o", "p q r s t u v w x", "y\tz a\tb c\td e\tf", "       {"]
    texts = ["\n".join(r.choice(pool) if r.random() < 0.93 else f"u{r.random()}" for _ in range(r.randint(1, 14))) for _ in range(120)]
    assert dropped(spark, texts) == plain(texts)


def test_long_gaps_and_ends(spark):
    run = "a b c d\n" + "\n" * 40 + "e f g h"
    long = "\n".join(f"line {k} of it" for k in range(30))
    texts = [f"p\n{run}\nq\n{long}", f"r\n{run}\ns\n{long}", long]
    assert dropped(spark, texts) == plain(texts) == {0: texts[0], 1: "r\ns"}
