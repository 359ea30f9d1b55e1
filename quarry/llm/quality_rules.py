"""Quality rules: text statistics, and perplexity bands of a word n-gram model per language.

Words are 64-bit hashes, lower-cased in A-Z, salted by language. Spark counts the word pairs of every whole text and
estimates an interpolated modified Kneser-Ney model by grouping on hashes: three discounts a
language from counts of counts, continuation counts for single words, back-off weights for contexts. A pair
that the model holds is scored by its own probability, any other by the weight of its context times that of the word.

Pairs are dealt over a grid by the hashes of context and word, packed in blocks, so that no frequent word comes whole
into one part. All pairs are counted first, which leaves what is known of each word: tables of hash and values, packed by part, in
the shared folder. Then each part meets the pairs of all texts and its share of those tables, counts the pairs of either fold
anew and scores the texts of the other. Rounds (slices of the grid) bound the pairs that are on disk at a time to
a part of the input; no table of pairs is kept, and none of words goes to the driver or a broadcast.

A text is scored by a model that has not seen it: each language has two, from texts of either fold, and a text is scored by the
model of the other fold. The fold is a bit of the least hash of the text's 3-word windows, so that copies, and
nearly all near copies, are in one fold and do not teach the model about each other.

A document is rejected by the method when its log perplexity lies above its
language's band (``ABOVE`` normalised median deviations over the median of all documents of the language that pass
the base rules), or the log perplexity of its words alone below theirs (``BELOW`` of them under the median); bands reach at
least ``LEAST_BAND`` to either side. Words alone have the model's continuation probabilities, which count the
contexts of a word and so do not grow with copies of a text: the few near copies that lie in both folds make each
other's pairs easy to foresee, but not their words, and are not rejected for it. A language with fewer than ``LEAST_DOCUMENTS`` such documents has no band: there
the base rules decide. No verdict depends on documents of another language.

Defined results: null or empty text has zero counts, null perplexity and fails
the base rules, as does any text of less than 50 words; a text of one word has null perplexity; very long texts are
read whole; null language counts as a language of its own (shown as empty); repeated rows are counted as often as
they occur, with equal verdicts; null doc_id is kept; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.llm import _bytes, _store

FOLD_WORDS = 3
BELOW, ABOVE = 6.0, 4.0
LEAST_BAND = 0.1
LEAST_DOCUMENTS = 20
COUNT_BYTES = 4 << 20  # text whose pairs are packed together before they are sent
SLICES = 4  # a power of two; texts are scored in so many rounds, so that only a part of their pairs is on disk at a time
PART_WORDS = 2_500_000  # pairs of a part, about
PACKED_WORDS = 200_000
SUM_BUCKETS = 256  # of texts, by key: their sums are packed

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

STATISTICS = ("key long, doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long")


def _salted(hashes: np.ndarray, rows: np.ndarray, models: np.ndarray) -> np.ndarray:
    """Word hashes that are equal only within a model."""
    return _bytes.mix(hashes + np.repeat(_bytes.mix(models), np.diff(rows)))


def folds(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """0 or 1 for each row: a bit of the least hash of its windows (0 for rows without one)."""
    grams, _, at = _bytes.windows(hashes, rows, FOLD_WORDS)
    out = np.zeros(len(rows) - 1, np.uint64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        out[some] = np.minimum.reduceat(grams, at[some]) >> np.uint64(20) & np.uint64(1)
    return out


@dataclass(frozen=True)
class Grid:
    """Parts of the pairs: ``rows`` by the hash of the context, ``cols`` by that of the word. Consecutive rows make a slice;
    slices are worked on one after the other."""

    slices: int = 1
    rows: int = 1
    cols: int = 1

    @classmethod
    def of(cls, n_words: int) -> Grid:
        parts = max(1, -(-n_words // PART_WORDS))
        slices = min(SLICES, 1 << parts.bit_length() - 1)
        many = max(1, round(math.sqrt(parts) / slices))  # rows of a slice
        return cls(slices, slices * many, -(-parts // (slices * many)))

    def fewer(self) -> Grid:
        """For distinct pairs, which are less: slices of twice the size."""
        return replace(self, slices=max(1, self.slices // 2))

    def row(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(16) & np.uint64(0xFFFFFF)) % np.uint64(self.rows)).astype(np.int64)

    def col(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(40)) % np.uint64(self.cols)).astype(np.int64)

    def rows_of(self, k: int) -> range:
        many = self.rows // self.slices
        return range(k * many, (k + 1) * many)


def _sql_row(grid: Grid) -> Column:
    return F.expr(f"CAST((shiftrightunsigned(hash, 16) & 16777215) % {grid.rows} AS INT)")


def _sql_col(grid: Grid) -> Column:
    return F.expr(f"CAST(shiftrightunsigned(hash, 40) % {grid.cols} AS INT)")


def _pairs(batch: pa.RecordBatch, grid: Grid, k: int):
    """For blocks of whole rows: keys and folds of the rows, and of each pair of neighbouring words that is in a slice
    its language, part, context, word and row."""
    langs = batch.column("lang_hash").to_numpy()
    keys = batch.column("key").to_numpy()
    own = grid.rows_of(k)
    for i, j, data, offsets in _bytes.row_blocks(batch.column("text"), COUNT_BYTES):
        hashes, rows = _bytes.words(data, offsets, lower=True)
        side = folds(hashes, rows).astype(np.uint8)
        distinct, lang = np.unique(langs[i:j], return_inverse=True)
        salted = _salted(hashes, rows, langs[i:j].view(np.uint64))
        ends = np.zeros(len(salted), bool)
        ends[rows[1:][np.diff(rows) > 0] - 1] = True
        at = grid.row(salted)
        first = np.flatnonzero(~ends & (at >= own.start) & (at < own.stop))
        row = np.repeat(np.arange(j - i), np.diff(rows))[first]
        part = (lang[row] * len(own) + at[first] - own.start) * grid.cols + grid.col(salted[first + 1])
        yield keys[i:j], side, distinct, part, salted[first], salted[first + 1], row


def _by_part(part: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Order by part and, in a part, by context: equal hashes side by side take little space."""
    by = np.argsort(context)
    small = part.astype(np.uint16) if len(part) and part.max() < 1 << 16 else part  # sorted by digits
    return by[np.argsort(small[by], kind="stable")]


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """The first place of each value."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def _unpacked(table: pa.Table, column: str, dtype, n: str = "size") -> np.ndarray:
    """Packed values of all rows, one after the other."""
    parts = [np.frombuffer(pa.decompress(x, size * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype)
             for x, size in zip(table.column(column).to_pylist(), table.column(n).to_pylist()) if size]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _dealt(grid: Grid, k: int, distinct: np.ndarray, part: np.ndarray):
    """Language, row and column of the parts that have pairs, and the first and last pair of each."""
    edges = np.append(_firsts(part), len(part))
    own = grid.rows_of(k)
    for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
        rest, col = divmod(int(part[s]), grid.cols)
        lang, row = divmod(rest, len(own))
        yield int(distinct[lang]), own.start + row, col, s, e


def _pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _bytes.mix(context * np.uint64(0x9E3779B97F4A7C15) + word)


COUNTED = "lang long, row int, col int, n long, size int, context binary, word binary, fold binary, times binary"
FOUND = "lang long, row int, col int, n long, size int, context binary, word binary, doc binary, n_docs int, keys binary, folds binary"


def count_pairs(docs: DataFrame, grid: Grid = Grid(), k: int = 0) -> DataFrame:
    """Distinct pairs of a slice with fold and count, packed for each block of texts and part (n: their sum)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(COUNTED)
        for batch in batches:
            for _, side, distinct, part, b, c, row in _pairs(batch, grid, k):
                fold = side[row]
                pair = _bytes.mix(_pair(b, c) + fold)
                by = np.argsort(pair)
                first = _firsts(pair[by])
                times, at = np.diff(np.append(first, len(by))).astype(np.uint32), by[first]
                by = _by_part(part[at], b[at])
                at, times = at[by], times[by]
                part, b, c, fold = part[at], b[at], c[at], fold[at]
                yield from _store.batches(
                    ((*place, int(times[s:e].sum()), e - s, *(_packed(x[s:e]) for x in (b, c, fold, times)))
                     for *place, s, e in _dealt(grid, k, distinct, part)), schema, 64)

    return docs.select("key", "text", "lang_hash").mapInArrow(count, COUNTED)


def document_pairs(docs: DataFrame, grid: Grid = Grid(), k: int = 0) -> DataFrame:
    """Pairs of a slice as often as they occur, with their texts, packed for each block of texts and part (n: their number)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(FOUND)
        for batch in batches:
            for keys, side, distinct, part, b, c, row in _pairs(batch, grid, k):
                by = _by_part(part, b)
                part, b, c, row = part[by], b[by], c[by], row[by]

                def packed(s, e):
                    has = np.zeros(len(keys), bool)
                    has[row[s:e]] = True
                    docs, doc = np.flatnonzero(has), (np.cumsum(has) - 1)[row[s:e]]
                    return (e - s, e - s, _packed(b[s:e]), _packed(c[s:e]), _packed(doc.astype(np.uint32)), len(docs),
                            _packed(keys[docs]), _packed(side[docs]))

                yield from _store.batches(((*place, *packed(s, e)) for *place, s, e in _dealt(grid, k, distinct, part)), schema, 64)

    return docs.select("key", "text", "lang_hash").mapInArrow(found, FOUND)


def _schema(ddl: str) -> pa.Schema:
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, types[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


SEEN = "lang long, fold int, hash long, n long, total long, k1 long, k2 long, k3 long, t3 long, t4 long"


def _seen(table: pa.Table) -> pa.Table:
    """Of all pairs of a part, for each word and fold: the contexts before it (n), and as a context the words after it (total)
    and how many distinct ones came once, twice and more often (k1, k2, k3), thrice and four times (t3, t4)."""
    b, c = _unpacked(table, "context", np.uint64), _unpacked(table, "word", np.uint64)
    fold, times = _unpacked(table, "fold", np.uint8), _unpacked(table, "times", np.uint32)
    pair = _bytes.mix(_pair(b, c) + fold)
    by = np.argsort(pair)
    pair = pair[by]
    first = _firsts(pair)
    times = np.add.reduceat(times[by].astype(np.int64), first)
    b, c, fold = b[by[first]], c[by[first]], fold[by[first]]
    out = []
    for f in (0, 1):
        own = fold == f
        hashes, at = np.unique(np.concatenate([b[own], c[own]]), return_inverse=True)
        before, after, t = at[:own.sum()], at[own.sum():], times[own]
        out.append((np.full(len(hashes), f, np.int32), hashes.view(np.int64), np.bincount(after, minlength=len(hashes)),
                    *(np.bincount(before, x, len(hashes)).astype(np.int64) for x in (t, t == 1, t == 2, t >= 3, t == 3, t == 4))))
    columns = [np.concatenate(x) for x in zip(*out)]
    return pa.Table.from_arrays([pa.array(np.full(len(columns[0]), table.column("lang")[0].as_py(), np.int64)),
                                 *(pa.array(x) for x in columns)], schema=_schema(SEEN))


def _discounts(table: DataFrame) -> DataFrame:
    """(lang, fold, d1, d2, d3, ...) from counts of counts (lang, fold, t1, t2, t3, t4, ...): one row a model."""
    t = table
    for k in (1, 2, 3, 4):
        t = t.withColumn(f"t{k}", F.col(f"t{k}").cast("double"))
    y = F.expr("t1 / (t1 + 2 * t2)")
    enough = F.expr("t1 > 0 AND t2 > 0 AND t3 > 0")  # else too even a table to estimate them
    for k, plain in ((1, 0.5), (2, 0.75), (3, 1.0)):
        d = F.lit(float(k)) - (k + 1) * y * F.col(f"t{k + 1}") / F.nullif(F.col(f"t{k}"), F.lit(0.0))
        t = t.withColumn(f"d{k}", F.when(enough, F.greatest(F.lit(0.05), F.least(d, F.lit(float(k))))).otherwise(plain))
    return t


MODEL = "lang long, fold int, at int, role int, size int, hashes binary, x binary, y binary"
CONTEXT, WORD, RULE = 0, 1, 2


def _model_part(role: int):

    def pack(table: pa.Table) -> pa.Table:
        head = [[table.column(c)[0].as_py()] for c in ("lang", "fold", "at")]
        body = [[_packed(table.column(c).to_numpy())] for c in ("hash", "x", "y")]
        return pa.table([pa.array(v, f.type) for v, f in zip([*head, [role], [len(table)], *body], _schema(MODEL))], schema=_schema(MODEL))

    return pack


def train(spark: SparkSession, docs: DataFrame, grid: Grid) -> tuple[DataFrame, DataFrame]:
    """The model: packed tables of hash and values (contexts: total, weight by row of the grid; words: probability by
    column), and a row for each model with its discounts and what a word gets that it does not hold."""
    slices, wide = [], grid.fewer()
    for k in range(wide.slices):
        seen = count_pairs(docs, wide, k).groupBy("lang", "row", "col").applyInArrow(_seen, SEEN)
        slices.append(_store.written(spark, seen, "words-seen"))
        _store.free_shuffles(spark)
    counts = [c.split()[0] for c in SEEN.split(", ")][3:]
    words = _store.written(spark, reduce(DataFrame.unionByName, slices).groupBy("lang", "fold", "hash").agg(
        *[F.sum(c).alias(c) for c in counts]), "words")
    _store.drop(spark, slices)
    # tables of one row a model: written, so that Spark sees their size before it picks a join
    model = words.groupBy("lang", "fold")
    pair_rule = _discounts(model.agg(F.sum("k1").alias("t1"), F.sum("k2").alias("t2"), F.sum("t3").alias("t3"), F.sum("t4").alias("t4")))
    word_rule = _discounts(model.agg(*[F.count_if(F.col("n") == k).alias(f"t{k}") for k in (1, 2, 3, 4)],
                                     F.count_if(F.col("n") >= 3).alias("t3_up"), F.count_if(F.col("n") > 0).alias("size"),
                                     F.sum("n").alias("all")))
    rules = _store.written(spark, pair_rule.select("lang", "fold", "d1", "d2", "d3").join(word_rule.select(
        "lang", "fold", "all", *[F.col(f"d{k}").alias(f"e{k}") for k in (1, 2, 3)],
        F.expr("(d1 * t1 + d2 * t2 + d3 * t3_up) / all / (size + 1)").alias("p_unknown")), ["lang", "fold"]), "rules")
    table, words = words, words.join(rules, ["lang", "fold"])
    pieces = -(-words.count() // (grid.rows * PACKED_WORDS)) or 1
    piece = F.pmod(F.col("hash"), F.lit(pieces))
    contexts = words.where("total > 0").select("lang", "fold", _sql_row(grid).alias("at"), piece.alias("piece"), "hash",
                                               F.col("total").cast("double").alias("x"),
                                               F.expr("(d1 * k1 + d2 * k2 + d3 * k3) / total").alias("y"))
    ends = words.where("n > 0").select(
        "lang", "fold", _sql_col(grid).alias("at"), piece.alias("piece"), "hash",
        F.expr("(n - CASE n WHEN 1 THEN e1 WHEN 2 THEN e2 ELSE e3 END) / all + p_unknown").alias("x"), F.lit(0.0).alias("y"))
    packed = [_store.written(spark, t.groupBy("lang", "fold", "at", "piece").applyInArrow(_model_part(role), MODEL), "model")
              for t, role in ((contexts, CONTEXT), (ends, WORD))]
    _store.drop(spark, [table])
    return packed[0].unionByName(packed[1]), rules.select("lang", "fold", "d1", "d2", "d3", "p_unknown")


SUMS = "key long, n long, p double, p_word double"
PACKED_SUMS = "bucket int, size int, key binary, n binary, p binary, p_word binary"


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums over the pairs of a part for each text, from the counts of the other fold in the part and the model."""
    if not len(left):
        return _schema(PACKED_SUMS).empty_table()
    b, c = _unpacked(left, "context", np.uint64), _unpacked(left, "word", np.uint64)
    keys, side = _unpacked(left, "keys", np.int64, "n_docs"), _unpacked(left, "folds", np.uint8, "n_docs")
    n_docs = left.column("n_docs").to_numpy()
    doc = _unpacked(left, "doc", np.uint32).astype(np.int64) + np.repeat(np.cumsum(n_docs) - n_docs, left.column("size").to_numpy())
    pair = _pair(b, c)
    by = np.argsort(pair)
    new = np.append(True, pair[by[1:]] != pair[by[:-1]])
    which = np.cumsum(new) - 1
    doc = doc[by]
    fold = side[doc]
    one = by[new]
    p, p_word = np.zeros(len(by)), np.zeros(len(by))
    contexts, of_context = np.unique(b[one], return_inverse=True)
    words, of_word = np.unique(c[one], return_inverse=True)
    of_role, of_fold = right.column("role").to_numpy(), right.column("fold").to_numpy()
    for f in (0, 1):  # the model, for texts of the other fold
        times = np.bincount(which, fold == f, len(one)).astype(np.int64)

        def held(role, wanted):
            t = right.filter(pa.array((of_role == role) & (of_fold == f)))
            hashes = _unpacked(t, "hashes", np.uint64)
            order = np.argsort(hashes)
            at = np.searchsorted(hashes, wanted, sorter=order).clip(max=max(0, len(hashes) - 1))
            at = order[at] if len(hashes) else at
            there = hashes[at] == wanted if len(hashes) else np.zeros(len(wanted), bool)
            return there, *(np.where(there, x[at], 1.0) if len(hashes) else np.ones(len(wanted))
                            for x in (_unpacked(t, "x", float), _unpacked(t, "y", float)))

        rule = right.filter(pa.array((of_role == RULE) & (of_fold == f)))
        # a fold without a text has no model: nothing is known of any word
        less, unknown = (np.array([0.0, *(rule.column(d)[0].as_py() for d in ("d1", "d2", "d3"))]),
                         rule.column("p_unknown")[0].as_py()) if len(rule) else (np.zeros(4), 1.0)
        there, alone, _ = held(WORD, words)
        alone = np.where(there, alone, unknown)[of_word]
        _, totals, weights = held(CONTEXT, contexts)
        some = (times - less[np.minimum(times, 3)]) / totals[of_context] + weights[of_context] * alone
        at = fold != f
        p[at], p_word[at] = np.log(some)[which[at]], np.log(alone)[which[at]]
    bucket = (keys.view(np.uint64) % np.uint64(SUM_BUCKETS)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    columns = [x[by] for x in (keys, np.bincount(doc, minlength=len(keys)), *(np.bincount(doc, x, len(keys)) for x in (p, p_word)))]
    stops = np.searchsorted(bucket[by], np.arange(SUM_BUCKETS + 1)).tolist()
    out = [(k, e - s, *(_packed(x[s:e]) for x in columns)) for k, (s, e) in enumerate(zip(stops[:-1], stops[1:])) if e > s]
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _schema(PACKED_SUMS))], schema=_schema(PACKED_SUMS))


def _summed(table: pa.Table) -> pa.Table:
    """Sums of the texts of a bucket over all parts."""
    keys, at = np.unique(_unpacked(table, "key", np.int64), return_inverse=True)
    sums = [np.bincount(at, _unpacked(table, c, kind), len(keys)) for c, kind in (("n", np.int64), ("p", float), ("p_word", float))]
    return pa.Table.from_arrays([pa.array(keys), pa.array(sums[0].astype(np.int64)), *map(pa.array, sums[1:])], schema=_schema(SUMS))


def log_perplexity(spark: SparkSession, docs: DataFrame, n_words: int) -> DataFrame:
    """(key, log_perplexity, log_words) of each text of two words or more: by the model, and by its words alone (each
    word after the first). Rows of one key are equal and get the mean of equal figures."""
    grid = Grid.of(n_words)
    model, rules = train(spark, docs, grid)
    cols = F.sequence(F.lit(0), F.lit(grid.cols - 1))
    sums, slices = [F.sum(c).alias(c) for c in ("n", "p", "p_word")], []
    for k in range(grid.slices):
        own = grid.rows_of(k)
        rows = F.sequence(F.lit(own.start), F.lit(own.stop - 1))
        # each row of the model goes to the parts that may ask for it
        contexts = model.where(F.col("role") == CONTEXT).where(F.col("at").between(own.start, own.stop - 1)).withColumn(
            "row", F.col("at")).withColumn("col", F.explode(cols))
        words = model.where(F.col("role") == WORD).withColumn("col", F.col("at")).withColumn("row", F.explode(rows))
        rule = rules.withColumn("role", F.lit(RULE)).withColumn("row", F.explode(rows)).withColumn("col", F.explode(cols))
        asked = contexts.unionByName(words).unionByName(rule, allowMissingColumns=True)
        found = document_pairs(docs, grid, k).groupBy("lang", "row", "col").cogroup(asked.groupBy("lang", "row", "col")).applyInArrow(
            _scored, PACKED_SUMS)
        slices.append(_store.written(spark, found.groupBy("bucket").applyInArrow(_summed, SUMS), "pair-sums"))
        _store.free_shuffles(spark)
    return reduce(DataFrame.unionByName, slices).groupBy("key").agg(*sums).select("key", *[
        (-F.col(k) / F.col("n")).alias(name) for k, name in (("p", "log_perplexity"), ("p_word", "log_words"))])


def statistics(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row."""
    n_rows = len(offsets) - 1
    hashes, rows = _bytes.words(data, offsets)

    def per_row(mask):
        seen = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=seen[1:])
        return seen

    solid = np.ones(256, bool)
    solid[list(_bytes.SPACES)] = False
    marks = np.zeros(256, bool)
    marks[list(SYMBOLS)] = True
    inside = solid[data]
    chars = np.diff(per_row(inside & ((data & 0xC0) != 0x80))[offsets])
    symbols = np.diff(per_row(marks[data])[offsets])

    starts, ends, line_rows = _bytes.spans(data, offsets, _bytes.NEWLINE)
    visible = per_row(inside)
    worded = visible[ends] > visible[starts]
    line_of = np.repeat(np.arange(n_rows), np.diff(line_rows))[worded]
    lines = _bytes.span_hashes(data, starts, _bytes.NEWLINE)[worded]
    _, firsts = np.unique(_of_row(lines, line_of), return_index=True)
    dups = np.bincount(line_of, minlength=n_rows) - np.bincount(line_of[firsts], minlength=n_rows)

    grams, begin, at = _bytes.windows(hashes, rows, 3)
    gram_of = np.repeat(np.arange(n_rows), np.diff(at))
    _, which, times = np.unique(_of_row(grams, gram_of), return_inverse=True, return_counts=True)
    again = begin[times[which] > 1]
    repeated = np.zeros(len(hashes), bool)
    for k in range(3):
        repeated[again + k] = True
    repeats = np.diff(per_row(repeated)[rows])
    return [np.diff(rows), chars, symbols, dups, repeats]


def _of_row(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within a row."""
    return _bytes.mix(hashes + _bytes.mix(row.astype(np.uint64) + np.uint64(1)))


def with_key(docs: DataFrame) -> DataFrame:
    """key, doc_id, text, lang and lang_hash; equal rows have one key."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"))
    return source.select(F.xxhash64("doc_id", "text", "lang").alias("key"), "doc_id", "text", "lang", F.xxhash64("lang").alias("lang_hash"))


def count_statistics(docs: DataFrame) -> DataFrame:

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in _bytes.row_blocks(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, j - i) for c in ("key", "doc_id", "lang")],
                     *[pa.array(c, pa.int64()) for c in statistics(data, offsets)]],
                    ["key", "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])

    return docs.mapInArrow(counted, STATISTICS)


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Statistics, log perplexity and verdict of each document."""
    docs = with_key(docs)
    counted = _store.written(spark, count_statistics(docs), "statistics")
    n_words = counted.agg(F.sum("n_words")).first()[0] or 0
    table = _store.written(spark, counted.join(log_perplexity(spark, docs, n_words), "key", "left"), "quality-rules")
    table = table.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                             | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))
    # one row a language, written so that Spark sees the size before it picks a join
    passed = table.where("NOT base_failed AND log_perplexity IS NOT NULL")

    def median(x):
        return F.percentile_approx(x, 0.5, 10000)

    middle = _store.written(spark, passed.groupBy("lang").agg(median("log_perplexity").alias("middle"), median("log_words").alias("middle_words"),
                                                              F.count(F.lit(1)).alias("size")), "middles")
    spread = passed.join(middle, "lang").groupBy("lang", "middle", "middle_words", "size").agg(
        median(F.abs(F.col("log_perplexity") - F.col("middle"))).alias("mad"),
        median(F.abs(F.col("log_words") - F.col("middle_words"))).alias("mad_words"))

    def width(times, mad):
        return F.greatest(F.lit(LEAST_BAND), F.lit(times * 1.4826) * F.col(mad))

    bands = _store.written(spark, spread.where(F.col("size") >= LEAST_DOCUMENTS).select(
        "lang", (F.col("middle_words") - width(BELOW, "mad_words")).alias("lower"),
        (F.col("middle") + width(ABOVE, "mad")).alias("upper")), "bands")
    inside = F.coalesce((F.col("log_words") >= F.col("lower")) & (F.col("log_perplexity") <= F.col("upper")), F.lit(True))
    return table.join(bands, "lang", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"), F.col("lang").alias("language_model"),
        F.exp("log_perplexity").alias("perplexity"), F.exp("log_words").alias("words_perplexity"),
        F.exp("lower").alias("lower_band"), F.exp("upper").alias("upper_band"))
