"""Suffix-array dedup: removes every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere.

Core (:func:`repeated_starts`): threshold-bounded interval expansion on a Burrows-Wheeler
transform. Intervals of suffixes with a common prefix are extended backwards, all of one depth at a
time; a bound between two suffixes that is first seen at depth v has a common prefix of v. The
expansion stops at ``LENGTH``: two neighbours without a bound by then share that many bytes.

Around it, Spark brings together only texts that may repeat, with all places of a string in one group:

1. In each window of LENGTH bytes the k-mer with the smallest hash is its anchor. Starts with the same
   anchor place are a run; its context is the bytes of all its windows. Equal windows have equal
   anchors. Anchors that occur once end here.
2. Equal contexts are counted first: all their windows repeat. Of each distinct context of an
   anchor that has several, one goes on.
3. Contexts are dealt by anchor; a task joins whole anchors to texts of about ``TEXT_BYTES``
   and expands intervals on each. An anchor with more than ``GROUP_CONTEXTS`` distinct contexts would make
   too large a text: the windows of its contexts are dealt by their hashes instead, counted within each task first.
4. Marked starts go back to all copies of a context, and each document is cut.

Strings are judged on the input; places in one document count, and overlaps do; matches never cross
documents. Defined results: null text counts as empty; texts shorter than LENGTH lose nothing; repeated rows
repeat each other; null doc_id is kept; very long texts are searched
whole; an empty table gives no row; other columns are ignored.
Contexts and window hashes of 64 bits that are equal count as equal bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import _bytes, _filter, _store

LENGTH = 400
KMER = 64  # a power of two
TEXT_BYTES = 256 << 10
GROUP_CONTEXTS = 512
FIRST_DEPTH = 32  # depth up to which prefix doubling gives the bounds; a power of two, at least 8
PACKED_HASHES = 1_000_000

RUNS = "doc_id long, text_hash long, start int, many int, anchor long, context long"


def kmer_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from every place that has so many."""
    h, width = _bytes._BYTE[data], 1
    while width < k:
        h = h[:-width] + h[width:] * np.uint64(pow(_bytes._MULT, width, 1 << 64))
        width *= 2
    return _bytes.mix(h)


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, kmer: int = KMER):
    """Row, start in the row, number of starts, anchor and context hash of each run."""
    n, w = len(data), length - kmer + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    bits = np.uint64((1 << max(23, int(n).bit_length())) - 1)
    h = kmer_hashes(data, kmer)
    least = (h & ~bits) | np.arange(len(h), dtype=np.uint64)  # ties go to the leftmost
    width = 1
    while 2 * width <= w:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < w:
        least = np.minimum(least[:len(least) - (w - width)], least[w - width:])
    place = (least & bits).astype(np.int64)
    valid = np.zeros(n + 1, np.int8)
    long = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(valid, offsets[long], 1)
    np.add.at(valid, offsets[long + 1] - length + 1, -1)
    valid = np.cumsum(valid[:len(place)]).astype(bool)
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
    edges = np.append(np.flatnonzero(change), len(place))
    starts, ends = edges[:-1], edges[1:]
    keep = valid[starts]
    starts, ends = starts[keep], ends[keep]
    row = np.searchsorted(offsets, starts, "right") - 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_bytes._BYTE[data] * _bytes.powers(n, _bytes._MULT), out=sums[1:])
    context = (sums[ends - 1 + length] - sums[starts]) * _bytes.powers(n, _bytes._INV)[starts]
    context = _bytes.mix(_bytes.mix(context) + (ends - starts).astype(np.uint64))
    return row, starts - offsets[row], ends - starts, h[place[starts]], context


def repeated_starts(text: np.ndarray, length: int = LENGTH, first_depth: int = FIRST_DEPTH) -> np.ndarray:
    """For each place, whether the ``length`` symbols from it stand at another place too.

    ``text`` has symbols from 1, and 0 as a separator behind every part; a string with a separator is
    never asked for. The text counts as cyclic."""
    n = len(text)
    order, bounds = _sorted_suffixes(text, length + 1, first_depth)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")  # place of the j-th symbol in sorted order
    forward = np.empty(n, np.int64)  # place of a suffix extended by the symbol before it
    forward[by_symbol] = np.arange(n)
    follows = np.append(by_symbol[1:], n)  # next place of the same symbol; n if there is none
    symbols = bwt[by_symbol]
    ends_block = np.append(symbols[1:] != symbols[:-1], True)
    begins_block = np.append(True, ends_block[:-1])
    before = np.append(0, by_symbol[:-1])
    # all intervals of the first depth
    left = np.flatnonzero(bounds[:-1])
    right = np.append(left[1:], n)
    for _ in range(first_depth, length):
        if not len(left):
            break
        size = right - left
        total = np.cumsum(size)
        each = np.arange(total[-1]) + np.repeat(left - (total - size), size)
        lo, hi = np.repeat(left, size), np.repeat(right, size)
        to = forward[each]
        last = ends_block[to] | (follows[to] >= hi)  # the symbol does not occur again in the interval
        first = begins_block[to] | (before[to] < lo)
        # intervals of one depth are apart, so both lists pair up in sorted order
        ends = np.sort(to[last]) + 1
        starts = np.sort(to[first])
        new = ~bounds[ends]
        bounds[ends[new]] = True
        left, right = starts[new], ends[new]
    out = np.zeros(n, bool)
    out[order] = ~(bounds[:-1] & bounds[1:])
    return out


def _sorted_suffixes(text: np.ndarray, depth: int, first_depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first symbols (``depth`` of them or more), and the bounds between
    neighbours that differ in the first ``first_depth``."""
    n = len(text)
    key = text.astype(np.uint64)
    wide = 1
    while wide < 4:  # four symbols of 16 bits
        key = (key << np.uint64(16 * wide)) | np.roll(key, -wide)
        wide *= 2
    order = np.argsort(key)
    s = key[order]
    new = np.append(True, s[1:] != s[:-1])
    rank = np.empty(n, np.int64)
    begin = np.flatnonzero(new)
    rank[order] = begin[np.cumsum(new) - 1]  # the first place of the group
    bounds = None
    while wide < depth:
        if wide == first_depth:
            bounds = np.append(new, True)
        # only groups of several are sorted again
        single = new & np.append(new[1:], True)
        at = np.flatnonzero(~single)
        if len(at):
            places = order[at]
            pair = (rank[places].astype(np.uint64) << np.uint64(32)) | rank[(places + wide) % n].astype(np.uint64)
            by = np.argsort(pair)
            places, pair = places[by], pair[by]
            order[at] = places
            diff = np.append(True, pair[1:] != pair[:-1])
            new = new.copy()
            new[at] = diff
            first = np.flatnonzero(diff)
            rank[places] = at[first[np.cumsum(diff) - 1]]
        wide *= 2
    return order, bounds


def _spans(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


MARKS = "anchor long, context long, first int, last int"


def _mark_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of repeated starts in contexts that come sorted by anchor."""

    def expanded(rows):
        size = sum(len(r[3]) + 1 for r in rows)
        text, at, k = np.zeros(size, np.uint16), [], 0
        for r in rows:
            b = np.frombuffer(r[3], np.uint8)
            text[k:k + len(b)] = b
            text[k:k + len(b)] += 1
            at.append(k)
            k += len(b) + 1
        marked = repeated_starts(text)
        out = []
        for (anchor, context, many, _), k in zip(rows, at):
            for a, b in zip(*_spans(marked[k:k + many])):
                out.append((anchor, context, int(a), int(b)))
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["anchor", "context", "first", "last"])

    rows, size = [], 0
    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in ("anchor", "context", "many", "bytes"))):
            if rows and size > TEXT_BYTES and r[0] != rows[-1][0]:
                yield expanded(rows)
                rows, size = [], 0
            rows.append(r)
            size += len(r[3]) + 1
    if rows:
        yield expanded(rows)


def _mark_by_hash(contexts: DataFrame, n_windows: int) -> DataFrame:
    """The same for the contexts of large groups: their windows are dealt by hash and counted."""
    bits = max(0, (n_windows // PACKED_HASHES).bit_length())
    buckets = 1 << bits

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, rows, hashes, size = TaskContext.get().partitionId() << 32, [], [], 0

        def flush():
            nonlocal chunk, rows, hashes, size
            h = np.concatenate(hashes)
            bucket = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
            order = np.argsort(bucket, kind="stable")
            stops = np.searchsorted(bucket[order], np.arange(buckets + 1))
            out = [(k, chunk, h[order[s:e]].tobytes(), order[s:e].astype(np.int32).tobytes())
                   for k, (s, e) in enumerate(zip(stops[:-1].tolist(), stops[1:].tolist())) if e > s]
            head = np.array(rows, np.int64)
            out.append((buckets + chunk % buckets, chunk, head.tobytes(), b""))
            chunk, rows, hashes, size = chunk + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "chunk", "left", "right"])

        for batch in batches:
            for anchor, context, many, raw in zip(*(batch.column(c).to_pylist() for c in ("anchor", "context", "many", "bytes"))):
                b = np.frombuffer(raw, np.uint8)
                sums = np.zeros(len(b) + 1, np.uint64)
                np.cumsum(_bytes._BYTE[b] * _bytes.powers(len(b), _bytes._MULT), out=sums[1:])
                hashes.append(_bytes.mix((sums[LENGTH:LENGTH + many] - sums[:many]) * _bytes.powers(many, _bytes._INV)))
                rows.append((anchor, context, many))
                size += many
                if size >= PACKED_HASHES:
                    yield flush()
        if rows:
            yield flush()

    def again(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() >= buckets:
            return pa.table({"chunk": table.column("chunk"), "head": table.column("left"), "places": table.column("right")})
        left = [np.frombuffer(x, np.uint64) for x in table.column("left").to_pylist()]
        _, which, times = np.unique(np.concatenate(left), return_inverse=True, return_counts=True)
        more, out, k = times[which] > 1, [], 0
        for x, y in zip(left, table.column("right").to_pylist()):
            out.append(np.frombuffer(y, np.int32)[more[k:k + len(x)]].tobytes())
            k += len(x)
        return pa.table({"chunk": table.column("chunk"), "head": pa.array([None] * len(out), pa.binary()), "places": pa.array(out, pa.binary())})

    def gather(table: pa.Table) -> pa.Table:
        (head,) = [np.frombuffer(x, np.int64).reshape(-1, 3) for x in table.column("head").to_pylist() if x is not None]
        marked = np.zeros(int(head[:, 2].sum()), bool)
        for x in table.column("places").to_pylist():
            marked[np.frombuffer(x, np.int32)] = True
        out, k = [], 0
        for anchor, context, many in head.tolist():
            out += [(anchor, context, int(a), int(b)) for a, b in zip(*_spans(marked[k:k + many]))]
            k += many
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                        names=["anchor", "context", "first", "last"])

    return (contexts.mapInArrow(deal, "bucket long, chunk long, left binary, right binary")
            .groupBy("bucket").applyInArrow(again, "chunk long, head binary, places binary")
            .groupBy("chunk").applyInArrow(gather, MARKS))


def _source(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def _only(frame: DataFrame, column: str, shared) -> DataFrame:
    """Rows whose hash may be in the broadcast filter."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _filter.inside(shared.value, batch.column(column).to_numpy().view(np.uint64))
            if len(at):
                yield batch.take(pa.array(at))

    return frame.mapInArrow(pick, frame.schema)


def repeated_spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans): for each document with repeated strings, the byte ranges they cover."""
    source = _source(docs)
    share = spark.sparkContext.broadcast

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in _bytes.row_blocks(batch.column("text")):
                row, start, many, anchor, context = anchored_runs(data, offsets)
                if len(row):
                    at = pa.array(row + i)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(at), batch.column("text_hash").take(at), pa.array(start.astype(np.int32)),
                         pa.array(many.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64))],
                        ["doc_id", "text_hash", "start", "many", "anchor", "context"])

    runs = _store.written(spark, source.mapInArrow(find, RUNS), "runs")
    twice = _store.written(spark, runs.groupBy("anchor").count().where("count > 1").select(F.col("anchor").alias("hash")), "anchors")
    runs = _store.written(spark, _only(runs, "anchor", share(_filter.bloom(twice))), "repeated-runs")

    contexts = _store.written(spark, runs.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "start", "many")).alias("one")), "contexts")
    groups = _store.written(spark, contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "groups")
    unsure = _store.written(spark, contexts.join(groups, "anchor").select("anchor", "context", "n", "m", "one.*"), "unsure")
    # their bytes, from the texts of the one document each
    texts = _only(source, "text_hash", share(_filter.bloom(unsure.select(F.col("text_hash").alias("hash")).distinct())))
    named = unsure.withColumnRenamed("doc_id", "of").withColumnRenamed("text_hash", "hash")
    bytes_ = F.expr(f"substring(CAST(text AS binary), start + 1, many + {LENGTH - 1})").alias("bytes")
    unsure = _store.written(spark, texts.join(named, (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("of")))
                            .select("anchor", "context", "n", "m", "many", bytes_).dropDuplicates(["anchor", "context"])
                            , "context-bytes")
    few = F.col("m") <= GROUP_CONTEXTS
    marks = (unsure.where(few).select("anchor", "context", "many", "bytes").repartition("anchor").sortWithinPartitions("anchor")
             .mapInArrow(_mark_groups, MARKS))
    windows = unsure.where(~few).agg(F.sum("many")).first()[0]
    if windows:
        marks = marks.unionByName(_mark_by_hash(unsure.where(~few), windows))
    copies = contexts.where("n > 1").select("anchor", "context", F.lit(0).alias("first"), F.col("one.many").alias("last"))
    alone = contexts.where("n = 1").select("anchor", "context")
    marks = _store.written(spark, copies.unionByName(marks.join(alone, ["anchor", "context"], "left_semi")), "marks")
    return runs.join(marks, ["anchor", "context"]).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct(
        (F.col("start") + F.col("first")).alias("s"), (F.col("start") + F.col("last") + (LENGTH - 1)).alias("e"))).alias("spans"))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(batches: Iterator[pa.RecordBatch], untouched_by=None) -> Iterator[pa.RecordBatch]:
    """The results of texts with their spans; with a broadcast filter, of those texts that are not in it."""
    for batch in batches:
        if untouched_by is not None:
            at = _filter.inside(untouched_by.value, batch.column("text_hash").to_numpy().view(np.uint64))
            batch = batch.take(pa.array(np.setdiff1d(np.arange(len(batch)), at, assume_unique=True)))
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            raw = text.encode()
            kept, at, n_spans, removed = [], 0, 0, 0
            for x in sorted((x["s"], x["e"]) for x in spans or ()):
                if x[0] > at or not n_spans:
                    kept.append(raw[at:x[0]])
                    n_spans += 1
                    removed += x[1] - x[0]
                else:
                    removed += max(0, x[1] - at)
                at = max(at, x[1])
            kept.append(raw[at:])
            rest = b"".join(kept)
            out.append((len(raw), removed, n_spans, hashlib.sha256(rest).hexdigest(), rest))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[k] for r in out], t) for k, t in enumerate(types))],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: what was removed, and the bytes that are kept."""
    spans = _store.written(spark, repeated_spans(spark, docs), "spans")
    source = _source(docs)
    # texts without a repeated string need no shuffle
    hashes = spark.sparkContext.broadcast(_filter.bloom(spans.select(F.col("text_hash").alias("hash")).distinct()))
    named = spans.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"), "spans")
    touched = _only(source, "text_hash", hashes).join(
        named, (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("of")), "left").select("doc_id", "text", "spans")
    whole = source.select("doc_id", "text", "text_hash", F.lit(None).cast("array<struct<s:int,e:int>>").alias("spans"))
    return touched.mapInArrow(_cut, RESULT).unionByName(whole.mapInArrow(lambda batches: _cut(batches, hashes), RESULT))
