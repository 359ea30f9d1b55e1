"""Documents with odd rows, and what the tests of several operators share."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Columns beyond those of the table, named like columns that the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, node string, key string, lines string, ids string, bytes string, label string")


def prose(seed: int, n: int) -> str:
    """n words in lines, the same for the same seed."""
    import random

    r = random.Random(seed)
    parts = ["the", "of", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "or", "ti", "wh", "ea"]
    words = ["".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n)]
    return "".join(w + (".\n" if i % 17 == 16 else " ") for i, w in enumerate(words)).strip()


def odd_rows() -> list[tuple[int | None, str | None, str | None]]:
    long = prose(1, 60_000)
    base = prose(2, 300)
    near = base.replace(base.split()[100], "changed", 1)
    return [
        (1, None, "en"), (2, "", "en"), (3, " \t\n\x0b ", "en"), (4, "word", "en"), (5, "one two three four", None),
        (6, base, "en"), (7, base, "en"), (7, base, "en"), (8, near, "de"), (9, long, "en"), (10, long[:200_000] + " end", "en"),
        (11, "x " * 400, "en"), (12, "\n".join(["a line that is said again and again, truly"] * 30), "fr"),
        (13, "Ünï cödé \U0001F600 ٣٤ 漢字     é\x00b <|endoftext|>\r\n'll 'S", "es"), (None, prose(3, 120), "en"),
        (None, None, None), (14, base.upper(), "en"), (15, prose(4, 90) + "\n" + prose(2, 300)[:700], "xx"), (-16, prose(5, 200), "en"),
        (2 ** 62, prose(6, 60) + "\nReleased under the MIT license.", "en"), (17, "a\n\n\n\n\nb\n\n\n\n\nc", "en"),
    ]


def best_labels(shares: dict[int, float], templates) -> set[str]:
    """Labels of the templates met (number: share), without those of which a rival is met better or, as well, with more words."""
    from quarry.llm import license_scan as ls

    words = [set(ls.template_words(t)) for _, t in templates]

    def beaten(t, o):
        rival = o != t and len(words[t] & words[o]) >= min(ls.need(len(words[t])), ls.need(len(words[o])))
        return rival and (shares[o] > shares[t] + 1e-12 or abs(shares[o] - shares[t]) < 1e-12 and words[t] < words[o])

    return {templates[t][0] for t in shares if not any(beaten(t, o) for o in shares)}


def own_word(block, t, templates) -> bool:
    """Whether the block has a word that only this template has, if there are any."""
    from quarry.llm import license_scan as ls

    words = [set(ls.template_words(x)) for _, x in templates]
    own = {w for w in words[t] if not any(w in x for o, x in enumerate(words) if o != t)}
    return not own or bool(own & set(block))


def odd_docs(spark):
    rows = [(i, t, lang, "src0", len(t) if t is not None else None, "r", "n", "k", "l", "i", "b", "x") for i, t, lang in odd_rows()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
