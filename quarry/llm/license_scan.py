"""License scan: exact set-similarity join of text blocks with license templates.

A block meets a template when it holds at least ``THRESHOLD`` of the template's
distinct words. Blocks are the lines, and, for notices wrapped over several
lines, all windows of as many words as the template has that lie in one
paragraph (lines up to one without a word; comment marks are no words). The
words of all templates are ordered by the number of times they occur in the
whole corpus, rarest first. The join probes only the prefix of each template
(any qualifying block holds one of its words; windows are taken around these),
and drops a candidate by length (too few template words) and by position (too
few words can follow the first common one) before the overlap is counted.
Beside it, ``BASE`` phrases are found as consecutive words of the whole text.

Words: A-Z lower-cased, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Defined
results: null or empty text has no word, no label and score 0; repeated rows
give one row each; null doc_id is kept; very long texts are read whole; an empty
table gives no row; other columns are ignored. DataFrame
expressions only. The one collected result is the count of each template word.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.llm import _store

# The phrases and labels of the base scan, and short notices of common licenses.
BASE = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by-4.0", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same for Spark after lower-casing, named by what it holds: Java matches this form four times as fast.
LOWERED_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
# Between two paragraphs: a line without a word.
PARAGRAPH_END = r"\n[^0-9a-z\x{80}-\x{10FFFF}\n]*+\n"


def all_words(text: str) -> list[str]:
    """Words of a template, in order."""
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def template_words(text: str) -> list[str]:
    """Distinct words of a template."""
    return sorted(set(all_words(text)))


def need(n_words: int, threshold: float = THRESHOLD) -> int:
    return math.ceil(threshold * n_words - 1e-9)


def own_words(sets: list[tuple[str, list[str]]]) -> list[list[str]]:
    """Of each template, the words that no other template has: at least one of them must stand in a block, where there are any."""
    return [[w for w in ws if sum(w in other for _, other in sets) == 1] for _, ws in sets]


def rivals(sets: list[tuple[str, list[str]]], threshold: float = THRESHOLD) -> list[tuple[list[int], list[int]]]:
    """Of each template, the others that share enough words with it to be met by the same block, and those of them that
    hold all its words."""
    out = []
    for t, (_, ws) in enumerate(sets):
        near = [o for o, (_, other) in enumerate(sets) if o != t
                and len(set(ws) & set(other)) >= min(need(len(ws), threshold), need(len(other), threshold))]
        out.append((near, [o for o in near if set(ws) < set(sets[o][1])]))
    return out


def _array(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _places(phrase: str) -> Column:
    """Word numbers at which the phrase's words stand one after the other in ``words``."""
    parts = phrase.split()
    test = " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(parts))
    last = f"size(words) - {len(parts)}"
    return F.expr(f"CASE WHEN {last} >= 0 THEN filter(sequence(0, {last}), i -> {test}) ELSE array() END")


def word_counts(lines: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each template word occurs in the corpus: one row per word of the templates."""
    found = (lines.select(F.explode(F.flatten("by_line")).alias("word")).where(F.col("word").isin(vocabulary))
             .groupBy("word").count().collect())
    return {w: 0 for w in vocabulary} | {r["word"]: r["count"] for r in found}


def _regions(paragraphs: Column, prefix: Column, most: int) -> Column:
    """The words around each prefix word, as far as a window of ``most`` words reaches within the paragraph: (words, c),
    with the prefix word at index ``c``."""
    def around(words):
        at = F.filter(F.transform(words, lambda w, i: F.when(F.array_contains(prefix, w), i)), lambda i: i.isNotNull())
        first = lambda i: F.greatest(i - (most - 1), F.lit(0))
        return F.transform(at, lambda i: F.struct(
            F.slice(words, first(i) + 1, i - first(i) + most).alias("words"), (i - first(i)).alias("c")))

    return F.flatten(F.transform(paragraphs, around))


def _wrapped(regions: DataFrame, probes: list, by_rank: list[str], lengths: list[int], own: list[list[str]]) -> DataFrame:
    """(row, template, label, common, n) of templates met by a window of as many words as they have; a window is found at its first
    common word in the order of the prefixes, so only words from there on are counted."""
    # a row per prefix word of the templates: bounded by TEMPLATES
    table = regions.sparkSession.range(1).select(F.explode(F.array(*[F.struct(
        F.lit(by_rank[r]).alias("word"), F.lit(t).alias("template"), F.lit(label).alias("label"), F.lit(n).alias("n"), F.lit(least).alias("least"),
        F.lit(lengths[t]).alias("length"), _array(by_rank[x] for x in ranks[p:]).alias("t"), _array(own[t]).cast("array<string>").alias("own"))
        for r, p, t, label, n, least, ranks in probes])).alias("x")).select("x.*")
    first = F.greatest(F.col("c") - F.col("length") + 1, F.lit(0))
    near = (regions.select("row", "words", "c", F.element_at("words", F.col("c") + 1).alias("word")).join(F.broadcast(table), "word")
            .withColumn("near", F.slice("words", first + 1, F.col("c") - first + F.col("length")))
            .where(F.size(F.array_intersect("near", "t")) >= F.col("least")))
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size("near") - F.col("length") + 1, F.lit(1))),
                          lambda s: F.when(_has_own(F.slice("near", s, F.col("length")), F.col("own")),
                                           F.size(F.array_intersect(F.slice("near", s, F.col("length")), F.col("t")))).otherwise(0))
    return near.withColumn("common", F.array_max(windows)).where("common >= least").select("row", "template", "label", "common", "n")


def _has_own(words: Column, own: Column) -> Column:
    return (F.size(own) == 0) | F.arrays_overlap(words, own)


def scan(spark: SparkSession, docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: word count, base places, labels, and the highest containment found."""
    sets = [(label, template_words(text)) for label, text in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    lines = docs.select(
        F.col("doc_id"), text.alias("text"),
        F.transform(F.split(text, "\n"), lambda x: F.regexp_extract_all(x, F.lit(LOWERED_WORD), F.lit(0))).alias("by_line"))

    counts = word_counts(lines, vocabulary)
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts[w], w)))}
    own, rival = own_words(sets), rivals(sets, threshold)
    probes = []  # (rank of a prefix word, its position, template, label, size, words needed, ranks of the template)
    for t, (label, ws) in enumerate(sets):
        ranks = sorted(rank[w] for w in ws)
        least = need(len(ws), threshold)
        probes += [(r, p, t, label, len(ws), least, ranks) for p, r in enumerate(ranks[:len(ws) - least + 1])]
    by_rank = sorted(vocabulary, key=rank.get)
    prefix = [by_rank[r] for r in sorted({p[0] for p in probes})]

    # One row per document with its counts, base places and the blocks that hold a prefix word. The key is the
    # row's own, so that repeated documents stay apart; written once because two readers follow.
    named = [x for x, _ in BASE]
    base = (
        lines.select("doc_id", F.aggregate(F.transform("by_line", F.size), F.lit(0).cast("long"), lambda a, n: a + n).alias("n_words"),
                     F.expr("CASE WHEN exists(by_line, l -> array_contains(l, 'license')) THEN flatten(by_line) ELSE array() END")
                     .alias("words"),
                     F.filter("by_line", lambda l: F.arrays_overlap(l, _array(prefix))).alias("blocks"), "text")
        .select("doc_id", "n_words", "blocks", "text", *[_places(x).alias(f"p{k}") for k, x in enumerate(named)]))
    places = F.concat(*[F.col(f"p{k}") for k in range(len(named))])
    lengths = [len(all_words(text)) for _, text in templates]
    paragraphs = F.when(F.size("blocks") > 0, F.transform(
        F.split("text", PARAGRAPH_END), lambda x: F.regexp_extract_all(x, F.lit(LOWERED_WORD), F.lit(0)))).otherwise(F.array())
    base = base.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        F.filter(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]),
                 lambda x: x.isNotNull()).alias("base_labels"), "blocks",
        _regions(paragraphs, _array(prefix), max(lengths)).alias("regions"))
    base = _store.written(spark, base, "license-blocks")

    ranks_of = F.create_map(*[x for w in vocabulary for x in (F.lit(w), F.lit(rank[w]))])
    blocks = base.select("row", F.posexplode("blocks").alias("block", "words")).select(
        "row", "block", F.array_sort(F.transform(F.array_intersect("words", _array(vocabulary)), lambda w: ranks_of[w])).alias("b"))
    # a row per prefix word of the templates: bounded by TEMPLATES
    table = spark.range(1).select(F.explode(F.array(*[F.struct(
        F.lit(r).alias("rank"), F.lit(p).alias("p"), F.lit(t).alias("template"), F.lit(label).alias("label"),
        F.lit(n).alias("n"), F.lit(least).alias("least"), F.array(*[F.lit(x) for x in ranks]).alias("t"),
        F.array(*[F.lit(rank[w]) for w in own[t]]).cast("array<int>").alias("own"))
        for r, p, t, label, n, least, ranks in probes])).alias("x")).select("x.*")
    hits = (blocks.where(F.size("b") >= min(p[5] for p in probes))
            .select("row", "block", "b", F.posexplode("b").alias("q", "rank"))
            .join(F.broadcast(table), "rank")
            .where((F.size("b") >= F.col("least"))
                   & (F.least(F.col("n") - F.col("p"), F.size("b") - F.col("q")) >= F.col("least"))))
    whole = (hits.where(_has_own(F.col("b"), F.col("own"))).withColumn("common", F.size(F.array_intersect("b", "t")))
             .where("common >= least").select("row", "template", "label", "common", "n"))
    wrapped = _wrapped(base.select("row", F.inline("regions")), probes, by_rank, lengths, own)
    # of rivals only the one that is met best, of equals the one with more words; a row has at most one entry per template
    numbers = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<int>")
    rival_of = F.array(*[F.struct(numbers(near).alias("near"), numbers(wider).alias("wider")) for near, wider in rival])
    met = whole.unionByName(wrapped).groupBy("row", "template", "label", "n").agg(F.max("common").alias("common"))
    met = met.groupBy("row").agg(F.collect_list(F.struct("template", "label", "common", "n")).alias("met"))
    beaten = lambda x: F.exists("met", lambda y: F.array_contains(F.get(rival_of, x["template"])["near"], y["template"]) & (
        (y["common"] * x["n"] > x["common"] * y["n"])
        | ((y["common"] * x["n"] == x["common"] * y["n"]) & F.array_contains(F.get(rival_of, x["template"])["wider"], y["template"]))))
    matched = met.select("row", F.array_distinct(F.transform(F.filter("met", lambda x: ~beaten(x)), lambda x: x["label"])).alias("found"),
                         F.array_max(F.transform("met", lambda x: x["common"] / x["n"])).alias("containment"))
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    return base.drop("blocks", "regions").join(matched, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base_labels")), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("containment", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)).alias("score"))


def _sql() -> str:
    def strings(xs):
        return "[" + ", ".join(f"'{x}'" for x in xs) + "]"

    places = []
    for phrase, _ in BASE:
        parts = phrase.split()
        test = " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(parts))
        places.append(f"list_filter(range(0, len(words) - {len(parts) - 1}), lambda i: {test})")
    labels = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(BASE))
    sets = [(label, template_words(text)) for label, text in TEMPLATES]
    rows = ", ".join(f"({t}, '{label}', {strings(ws)}, {need(len(ws))}, {strings(own)}::VARCHAR[], {near}::INT[], {wider}::INT[])"
                     for t, ((label, ws), own, (near, wider)) in enumerate(zip(sets, own_words(sets), rivals(sets))))
    word = WORD.replace("'", "''")
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT n, doc_id, t, regexp_extract_all(t, '{word}') AS words FROM d),
p AS (SELECT *, {", ".join(f"{x} AS p{k}" for k, x in enumerate(places))} FROM w),
lines AS (SELECT n, unnest(string_split(t, chr(10))) AS line FROM d),
blocks AS (SELECT n, list_distinct(regexp_extract_all(line, '{word}')) AS b FROM lines),
templates(t, label, ws, least, own, near, wider) AS (VALUES {rows}),
met AS (
  SELECT n, t, label, near, wider, max(len(list_intersect(b, ws)) / len(ws)) AS share
  FROM blocks, templates WHERE len(list_intersect(b, ws)) >= least AND (len(own) = 0 OR list_has_any(b, own)) GROUP BY ALL),
matched AS (
  SELECT n, list(DISTINCT label) AS found, max(share) AS containment FROM met m
  WHERE NOT EXISTS (SELECT 1 FROM met o WHERE o.n = m.n AND list_contains(m.near, o.t)
                    AND (o.share > m.share OR (o.share = m.share AND list_contains(m.wider, o.t)))) GROUP BY n),
a AS (
  SELECT *, list_concat({", ".join(f"p{k}" for k in range(len(BASE)))}) AS places,
         list_filter([{labels}], lambda x: x IS NOT NULL) AS base FROM p)
SELECT doc_id, len(words) AS n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ','), '') AS labels,
  greatest(coalesce(containment, 0.0), CASE WHEN len(places) > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score
FROM a LEFT JOIN matched USING (n)
"""


SQL = _sql()
