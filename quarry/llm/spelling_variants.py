"""Spelling variants: words one edit apart, by dynamic programming over sorted lists of words.

Words are counted over all texts, first within blocks of text and tasks. Two words that differ by one inserted, deleted or
replaced code point agree in the first half of either one (its first ``k = length // 2`` code points) or in the
rest of it. So every word stands in two lists, one for its first and one for its second half, and asks in the
lists of the halves that a neighbour could share with it (lengths up to one more or less). What is compared in a
list is the other half of its words.

A list is sorted, and adjacent words share the rows of the edit matrix up to their longest common prefix: words that
agree so far are one range with one row, of which the band of three cells that can hold a distance of at most one is
kept. The scan goes from depth to depth for all asking words and ranges at once: a range splits where the
common prefix of neighbours ends, each part extends the row of the range, and a range whose
row exceeds one edit is skipped with all its words. No word is compared with a list as a whole.

A list of more than ``LIST_WORDS`` words is cut into parts, and so are its askers; every part meets every part in a
task of its own. A pair that both halves find is counted for the first half only.

A word's form is the near word of largest count, if that is at least ``FORM_TIMES`` its own (ties: smallest in
code-point order); roots follow forms by doubling steps, as many rounds as the logarithm of the longest chain.

Defined results: null text has no words; texts and words of any length are read whole; a null doc_id is written as nothing before
the colon; repeated rows count as often as they occur; other columns, whatever their names, are ignored; an empty table gives no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import _bytes, _store

LEAST_LETTERS = 5
LEAST_COUNT = 3
FORM_TIMES = 2
DROP_EVERY = 97
LIST_WORDS = 4096
ASKERS = 16384
SLAB_ROWS = 100_000
BLOCK_BYTES = 4 << 20


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of A-Z, a-z and U+00C0-U+00FF: the bytes with A-Z lower-cased and all others blank, starts, ends
    and the first run of each row (with an end entry)."""
    lead = data == 0xC3  # U+00C0-U+00FF are C3 and any second byte
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    clean = np.where(inside, data, 0x20).astype(np.uint8)
    clean[(clean >= 65) & (clean <= 90)] += 32
    return clean, *_bytes.spans(clean, offsets)


def run_crcs(clean: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 of each run after what gave ``state`` (a CRC-32 of the bytes before it)."""
    crc = state ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(starts - ends, kind="stable")  # longest first
    at, left = starts[order], (ends - starts)[order]
    crc = crc[order]
    n, step = len(order), 0
    while n:
        n = int(np.searchsorted(-left, -step, "left"))  # runs longer than step
        crc[:n] = _CRC[(crc[:n] ^ clean[at[:n] + step]) & np.uint32(0xFF)] ^ (crc[:n] >> np.uint32(8))
        step += 1
    out = np.empty_like(crc)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def word_counts(docs: DataFrame, drop_every: int = DROP_EVERY, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all texts. Of a run whose hash with its doc_id is divisible by ``drop_every``,
    the code point at that hash modulo its length is left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["" if d is None else d for d in batch.column("doc_id").to_pylist()]
            for i, j, data, offsets in _bytes.row_blocks(batch.column("text"), BLOCK_BYTES):
                clean, starts, ends, rows = runs(data, offsets)
                if not len(starts):
                    continue
                state = np.array([zlib.crc32(f"{d}:".encode()) for d in names[i:j]], np.uint32)
                crc = run_crcs(clean, starts, ends, np.repeat(state, np.diff(rows)))
                keep = (ends - starts) >= least_letters
                odd = np.flatnonzero(keep & (crc % np.uint32(drop_every) == 0))
                found: dict[str, int] = {}
                raw = clean.tobytes()
                for s, e, h in zip(starts[odd].tolist(), ends[odd].tolist(), crc[odd].tolist()):
                    w = raw[s:e].decode()
                    p = h % len(w)
                    if len(w) > least_letters:
                        found[w[:p] + w[p + 1:]] = found.get(w[:p] + w[p + 1:], 0) + 1
                hashes = _bytes.span_hashes(clean, starts)
                keep[odd] = False
                at = np.flatnonzero(keep)
                _, sample, n = np.unique(hashes[at], return_index=True, return_counts=True)
                for s, e, c in zip(starts[at[sample]].tolist(), ends[at[sample]].tolist(), n.tolist()):
                    w = raw[s:e].decode()
                    if len(w) >= least_letters:
                        found[w] = found.get(w, 0) + c
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def lists(words: DataFrame) -> DataFrame:
    """(key, asks, word, n): the two lists of each word (asks 0), and the lists that it asks in (asks 1)."""
    length = F.char_length("word")
    half = lambda side, k: F.concat(F.lit(side), F.substring("word", F.lit(1), k) if side == "<" else F.right("word", k))
    own = F.floor(length / 2).cast("int")
    keys = [F.struct(half("<", own).alias("key"), F.lit(0).alias("asks")), F.struct(half(">", length - own).alias("key"), F.lit(0).alias("asks"))]
    for other in (-1, 0, 1):
        first = F.floor((length + other) / 2).cast("int")
        keys += [F.struct(half("<", first).alias("key"), F.lit(1).alias("asks")), F.struct(half(">", length + other - first).alias("key"), F.lit(1).alias("asks"))]
    return words.select("word", "n", F.explode(F.array_distinct(F.array(*keys))).alias("place")).select("place.key", "place.asks", "word", "n")


def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and where each begins (with an end entry)."""
    ends = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=ends[1:])
    return np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int16), ends


def _at(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, depth: int) -> np.ndarray:
    """The code point at ``depth`` of each word, -1 beyond its end."""
    return np.where(depth < size, flat[np.minimum(begin + depth, len(flat) - 1)], -1)


def scan(group: np.ndarray, words: list[bytes], ask_group: np.ndarray, askers: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (asker, word) of one group at distance one, and whether the word's code points but the last are the asker's first.

    ``words`` are sorted within ascending groups and distinct there. A state is an asker with a range of words that agree
    up to the depth, and the band of the edit matrix's row: its cells below, on and above the diagonal."""
    flat, begin = _flat(words)
    size, begin = np.diff(begin), begin[:-1]
    q_flat, q_begin = _flat(askers)
    q_size, q_begin = np.diff(q_begin), q_begin[:-1]
    lo, hi = np.searchsorted(group, ask_group, "left"), np.searchsorted(group, ask_group, "right")
    asker = np.flatnonzero(hi > lo)
    lo, hi = lo[asker], hi[asker]
    many = len(asker)
    below, on, above = np.full(many, 9, np.int8), np.zeros(many, np.int8), np.ones(many, np.int8)
    was_equal = np.zeros(many, bool)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    new = np.append(True, group[1:] != group[:-1])  # first words of ranges
    number = np.arange(len(words))
    depth = 0
    while len(asker):
        if depth >= 16 and not depth & (depth - 1):  # go on with the words of the ranges that are left
            edge = np.zeros(len(number) + 1, np.int64)
            np.add.at(edge, lo, 1)
            np.add.at(edge, hi, -1)
            inside = np.cumsum(edge)[:-1] > 0
            new[lo] = True
            place = np.cumsum(inside) - 1
            lo, hi = place[lo], place[lo] + hi - lo
            size, begin, new, number = size[inside], begin[inside], new[inside], number[inside]
        # a word that ends here is the first of its range
        over = size[lo] == depth
        gap = q_size[asker] - depth
        distance = np.where(gap == -1, below, np.where(gap == 0, on, np.where(gap == 1, above, 9)))
        hit = np.flatnonzero(over & (distance == 1))
        found.append((asker[hit], number[lo[hit]], was_equal[hit]))
        # ranges of the next depth: words that go on, cut where the common prefix with the word before ends
        code = _at(flat, begin, size, depth)
        new[1:] |= code[1:] != code[:-1]
        first = np.flatnonzero(new & (code >= 0))
        stop = np.append(np.flatnonzero(new), len(number))
        a, b = np.searchsorted(first, lo), np.searchsorted(first, hi)
        state = np.repeat(np.arange(len(asker)), b - a)
        at = first[np.arange(len(state)) + np.repeat(a - np.append(0, np.cumsum(b - a)[:-1]), b - a)] if len(state) else np.zeros(0, np.int64)
        asker, c = asker[state], code[at]
        qb, qs = q_begin[asker], q_size[asker]
        below, on, above = below[state], on[state], above[state]
        was_equal = on == 0
        next_below = np.minimum(below + (_at(q_flat, qb, qs, depth - 1) != c if depth else 9), on + 1).astype(np.int8)
        next_on = np.minimum(np.minimum(on + (_at(q_flat, qb, qs, depth) != c), above + 1), next_below + 1).astype(np.int8)
        next_above = np.minimum(above + (_at(q_flat, qb, qs, depth + 1) != c), next_on + 1).astype(np.int8)
        near = np.flatnonzero(np.minimum(np.minimum(next_below, next_on), next_above) <= 1)
        asker, lo, below, on, above, was_equal = asker[near], at[near], next_below[near], next_on[near], next_above[near], was_equal[near]
        hi = stop[np.searchsorted(stop, lo, "right")]
        depth += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found))


def near_in_lists(rows: list[tuple[str, int, str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest count, its smallest word) for the askers of rows (list, asks, word, n), lists ascending."""
    names: dict[str, int] = {}
    listed, asking = [], []
    for name, asks, word, n in rows:
        g = names.setdefault(name, len(names))
        half = len(name.rsplit("|", 1)[0]) - 1
        front = name[0] == "<"
        rest = (word[half:] if front else word[:len(word) - half]).encode("latin-1")
        (asking if asks else listed).append((g, rest, word, n, front, word[len(word) - half] if not front else ""))
    if not listed or not asking:
        return
    listed.sort(key=lambda r: (r[0], r[1]))
    q, w, same_start = scan(np.array([r[0] for r in listed]), [r[1] for r in listed], np.array([r[0] for r in asking]), [r[1] for r in asking])
    # found in the list of the first half too: the word's first half is the asker's
    back = np.array([not r[4] for r in listed])[w]
    w_size, q_size = np.array([len(r[1]) for r in listed])[w], np.array([len(r[1]) for r in asking])[q]
    last = np.array([r[1][-1] if r[1] else 0 for r in listed])[w]
    following = np.array([ord(r[5]) if r[5] else 0 for r in listed])[w]
    longer = back & (q_size == w_size + 1)
    for k in np.flatnonzero(longer).tolist():
        longer[k] = asking[q[k]][1][:-1] == listed[w[k]][1]
    twice = longer | (back & (q_size == w_size - 1) & same_start & (last == following))
    q, w = q[~twice], w[~twice]
    n = np.array([r[3] for r in listed])[w]
    rank = np.empty(len(listed), np.int64)
    rank[sorted(range(len(listed)), key=lambda k: listed[k][2])] = np.arange(len(listed))
    order = np.lexsort((rank[w], -n, q))
    q, w, n = q[order], w[order], n[order]
    begin = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    for k, many in zip(begin.tolist(), np.diff(np.append(begin, len(q))).tolist()):
        yield asking[q[k]][2], many, int(n[k]), listed[w[k]][2]


def near_words(spark: SparkSession, words: DataFrame, list_words: int = LIST_WORDS, askers: int = ASKERS) -> DataFrame:
    """(word, n_near, near_n, near): how many words are one edit away, and the one of largest count."""
    placed = _store.written(spark, lists(words), "spelling-lists")
    size = placed.groupBy("key").agg(F.count_if(F.col("asks") == 0).alias("listed"), F.count_if(F.col("asks") == 1).alias("asking")).where("listed > 0")
    long = _store.written(spark, size.where((F.col("listed") > list_words) | (F.col("asking") > askers)).select(
        "key", F.ceil(F.col("listed") / list_words).cast("int").alias("v"), F.ceil(F.col("asking") / askers).cast("int").alias("q")), "spelling-long")
    part = placed.join(long, "key", "left").withColumn("v", F.coalesce("v", F.lit(1))).withColumn("q", F.coalesce("q", F.lit(1)))
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    own = lambda c: F.array(F.pmod(F.xxhash64("word"), F.col(c)).cast("int"))
    part = part.withColumn("v", F.explode(F.when(F.col("asks") == 0, own("v")).otherwise(every("v")))).withColumn(
        "q", F.explode(F.when(F.col("asks") == 1, own("q")).otherwise(every("q"))))
    part = part.select(F.concat_ws("|", "key", F.concat_ws("-", "v", "q")).alias("list"), "asks", "word", "n")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            rows: list[tuple] = []
            for batch in batches:
                rows += zip(*(batch.column(c).to_pylist() for c in ("list", "asks", "word", "n")))
                if len(rows) > SLAB_ROWS:  # whole lists only
                    k = len(rows) - 1
                    while k and rows[k - 1][0] == rows[-1][0]:
                        k -= 1
                    yield from near_in_lists(rows[:k])
                    rows = rows[k:]
            yield from near_in_lists(rows)

        yield from _store.batches(found(), pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())]))

    pairs = part.repartition("list").sortWithinPartitions("list").mapInArrow(near, "word string, n_near long, near_n long, near string")
    return pairs.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) of every (word, form) with a form: counts grow along forms, so each chain ends."""
    steps = _store.written(spark, forms.select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = _store.written(spark, steps.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("on")),
                                 "spelling-roots")
        if further.where("on").isEmpty():
            return further.select("word", "root")
        steps = further.select("word", "root")


def variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = _store.written(spark, word_counts(docs), "spelling-words")
    near = _store.written(spark, words.join(near_words(spark, words), "word", "left"), "spelling-near")
    form = F.when(F.col("near_n") >= FORM_TIMES * F.col("n"), F.col("near"))
    table = near.select("word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form.isNotNull(), F.col("near_n")).alias("form_n"))
    ends = roots(spark, table.where("form IS NOT NULL"))
    return table.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
