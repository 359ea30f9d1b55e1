"""License notices wrapped over several lines (8)."""

import re
import textwrap

import pytest

from llm_cases import best_labels, own_word, prose
from quarry.llm import license_scan as ls

MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
"""
BSD = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:
 *
 * 1. Redistributions of source code must retain the above copyright
"""
ISC = """# Permission to use, copy, modify, and/or distribute this software for any
# purpose with or without fee is hereby granted, provided that the above
"""
MPL = """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
"""
CC0 = """To the extent possible under law, Some Body has waived
all copyright and related or neighboring rights to
this work."""


def scanned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [r for r in sorted(ls.scan(spark, df).collect(), key=lambda r: r.doc_id)]


def test_real_notices(spark):
    texts = [MIT, BSD, ISC, MPL, CC0, MIT.replace("\n", "\r\n"), prose(1, 900) + "\n" + BSD + prose(2, 900)]
    rows = scanned(spark, texts)
    assert [r.labels for r in rows] == ["mit", "bsd", "isc", "mpl-2.0", "cc0-1.0", "mit", "bsd"]
    assert [r.score for r in rows][:4] == [1.0] * 4 and rows[4].score >= ls.THRESHOLD and rows[6].score == 1.0


@pytest.mark.parametrize("width", [12, 30, 72])
def test_every_template_at_every_width(spark, width):
    texts = [prose(k, 60) + ".\n" + textwrap.fill(t, width, initial_indent="; ", subsequent_indent="; ", break_long_words=False) + "\n" + prose(k + 50, 60)
             for k, (_, t) in enumerate(ls.TEMPLATES)]
    for (label, _), r in zip(ls.TEMPLATES, scanned(spark, texts)):
        assert label in r.labels.split(",") and r.score == 1.0


def windows(text):
    """Labels and containment by lines and by windows of paragraphs, in plain Python and without filters."""
    text = text.translate(str.maketrans(ls.UPPER, ls.LOWER))
    lines = [re.findall(ls.WORD, x) for x in text.split("\n")]
    paragraphs = [[]]
    for x in lines:
        if x:
            paragraphs[-1] += x
        else:
            paragraphs.append([])
    shares = {}
    for k, (_, t) in enumerate(ls.TEMPLATES):
        ws, n = set(ls.template_words(t)), len(ls.all_words(t))
        blocks = lines + [p[i:i + n] for p in paragraphs for i in range(max(1, len(p) - n + 1))]
        share = max((len(ws & set(b)) / len(ws) for b in blocks if own_word(b, k, ls.TEMPLATES)), default=0)
        if share >= ls.THRESHOLD - 1e-12:
            shares[k] = share
    return best_labels(shares, ls.TEMPLATES), max(shares.values(), default=0.0)


def test_against_plain_windows(spark):
    import random

    r = random.Random(5)
    some = sorted({w for _, t in ls.TEMPLATES for w in ls.all_words(t)})
    texts = []
    for _ in range(150):
        words = []
        for _ in range(3):
            t = ls.all_words(r.choice(ls.TEMPLATES)[1])
            words += [r.choice(some) if r.random() < 0.12 else w for w in t] + r.choices(some, k=r.randint(0, 9))
        texts.append("".join(w + r.choice([" ", " ", " ", "\n", "\n", "\n\n", " \n# \n\n\n"] if r.random() < 0.4 else [" "]) for w in words))
    for text, row in zip(texts, scanned(spark, texts)):
        found, best = windows(text)
        assert set(row.labels.split(",")) - {""} == found | set(row.base_labels.split(",")) - {""}
        assert row.score == max(best, 1.0 if row.n_base else 0.0)


def test_far_words_are_no_notice(spark):
    words = ls.all_words(ls.TEMPLATES[1][1])
    scattered = "\n".join(w + " " + prose(k, 9) for k, w in enumerate(words))
    apart = "\n\n".join(" ".join(words[i:i + 6]) for i in range(0, len(words), 6))
    assert [r.labels for r in scanned(spark, [scattered, apart])] == ["", ""]
