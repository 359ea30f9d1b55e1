"""Bounded-space online packing of documents into fixed-size training sequences.

Each partition tokenises its documents and keeps ``open_windows`` open windows.
The piece of a document that is shorter than a window goes whole into the
fullest open window that still holds it (best fit). When none fits, the fullest
window is emitted and a new one is opened; if more than ``max_gap`` positions
of the emitted window are free, they are filled by cutting the incoming piece.
The windows that are still open at the end of a partition are written too,
marked as open; a last small job merges them, many partitions to a task, by the
same rule, and joins what is then left into full windows.

Defined results: null text counts as empty (its one id is ``end_id``); null
doc_id is kept as it is; equal rows are packed as often as they occur; other
columns are ignored; an empty table gives no sequence. Memory: one batch of
documents and the open windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import _bytes, _store

CAPACITY = 1024
OPEN_WINDOWS = 64
MAX_GAP = 8
MERGED_WINDOWS = 4096  # open windows that one merge task takes

SEQUENCES = pa.schema([
    ("sequence_id", pa.int64()), ("closed", pa.bool_()), ("length", pa.int64()),
    ("doc_id", pa.list_(pa.int64())), ("start", pa.list_(pa.int64())), ("count", pa.list_(pa.int64())),
    ("doc_tokens", pa.list_(pa.int64())), ("ids", pa.binary()),
])
SEQUENCES_DDL = ("sequence_id long, closed boolean, length long, doc_id array<long>, start array<long>, "
                 "count array<long>, doc_tokens array<long>, ids binary")

Piece = tuple  # (doc_id, start, ids, doc_tokens)


class Packer:
    """The open windows of one task; each window is [used, pieces]."""

    def __init__(self, capacity: int, open_windows: int, max_gap: int, prefix: int):
        self.capacity, self.most, self.max_gap = capacity, open_windows, max_gap
        self.open: list[list] = []
        self.next_id = prefix

    def row(self, pieces: list[Piece], closed: bool) -> tuple:
        self.next_id += 1
        return (self.next_id - 1, closed, sum(len(p[2]) for p in pieces), [p[0] for p in pieces], [p[1] for p in pieces],
                [len(p[2]) for p in pieces], [p[3] for p in pieces], np.concatenate([p[2] for p in pieces]).tobytes())

    def add(self, pieces: list[Piece]) -> Iterator[tuple]:
        """Place pieces that belong together (a document's rest, or an open window of another task)."""
        used = sum(len(p[2]) for p in pieces)
        if not used:
            return
        if used == self.capacity:
            yield self.row(pieces, True)
            return
        best = None
        for w in self.open:
            if w[0] + used <= self.capacity and (best is None or w[0] > best[0]):
                best = w
        if best is None and len(self.open) >= self.most:
            full = max(self.open, key=lambda w: w[0])
            self.open.remove(full)
            if self.capacity - full[0] > self.max_gap:
                taken, pieces = cut(pieces, self.capacity - full[0])
                full[1] += taken
            yield self.row(full[1], True)
            yield from self.add(pieces)
            return
        if best is None:
            best = [0, []]
            self.open.append(best)
        best[0] += used
        best[1] += pieces
        if best[0] == self.capacity:
            self.open.remove(best)
            yield self.row(best[1], True)

    def rest(self) -> Iterator[tuple]:
        for _, pieces in self.open:
            yield self.row(pieces, False)

    def joined(self) -> Iterator[tuple]:
        """The open windows, fullest first, cut into full windows and one last."""
        pieces = [p for w in sorted(self.open, key=lambda w: -w[0]) for p in w[1]]
        while pieces:
            taken, pieces = cut(pieces, self.capacity)
            yield self.row(taken, True)


def cut(pieces: list[Piece], n: int) -> tuple[list[Piece], list[Piece]]:
    """The first n ids of the pieces, and the others."""
    taken, k = [], 0
    while k < len(pieces) and n > 0:
        doc, start, ids, total = pieces[k]
        if len(ids) > n:
            taken.append((doc, start, ids[:n], total))
            return taken, [(doc, start + n, ids[n:], total), *pieces[k + 1:]]
        taken.append(pieces[k])
        n -= len(ids)
        k += 1
    return taken, pieces[k:]


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
         open_windows: int = OPEN_WINDOWS, end_id: int = 0, max_gap: int = MAX_GAP) -> DataFrame:
    """One row per sequence: its ids (little-endian unsigned 32-bit) and, in parallel arrays, its pieces."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm._tokens import tokenizer

        tok = tokenizer(tokenizer_path)
        packer = Packer(capacity, open_windows, max_gap, TaskContext.get().partitionId() << 32)

        def rows():
            for batch in batches:
                data, offsets = _bytes.utf8(batch.column("text"))
                doc_ids = batch.column("doc_id").to_pylist()
                for i, j in _bytes.blocks(offsets, 8 << 20):
                    ids, at = tok.encode(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                    for k in range(i, j):
                        own = np.append(ids[at[k - i]:at[k - i + 1]], np.uint32(end_id))
                        whole = len(own) - len(own) % capacity
                        for s in range(0, whole, capacity):
                            yield packer.row([(doc_ids[k], s, own[s:s + capacity], len(own))], True)
                        yield from packer.add([(doc_ids[k], whole, own[whole:], len(own))])
            yield from packer.rest()

        yield from _store.batches(rows(), SEQUENCES, 512)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, open_windows, max_gap, (1 << 62) + (TaskContext.get().partitionId() << 32))

        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    ids, at, pieces = np.frombuffer(r["ids"], "<u4"), 0, []
                    for d, s, c, t in zip(r["doc_id"], r["start"], r["count"], r["doc_tokens"]):
                        pieces.append((d, s, ids[at:at + c], t))
                        at += c
                    yield from packer.add(pieces)
            yield from packer.joined()

        yield from _store.batches(rows(), SEQUENCES, 512)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = _store.written(spark, source.mapInArrow(packed, SEQUENCES_DDL), "packed")
    left = first.where(~F.col("closed"))
    tasks = max(1, -(-left.count() // MERGED_WINDOWS))
    last = (left.repartition(tasks, F.xxhash64("sequence_id")).sortWithinPartitions("sequence_id")
            .mapInArrow(merged, SEQUENCES_DDL))
    # the merged windows are few: written, so that every reader sees the same ids
    return first.where("closed").unionByName(_store.written(spark, last, "packed-rest")).drop("closed")


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece of each sequence, with the checksum of its ids."""
    before = "aggregate(slice(count, 1, i), 0L, (a, x) -> a + x)"
    return (
        sequences.select("sequence_id", "ids", "doc_id", "start", "count", "doc_tokens",
                         F.explode(F.sequence(F.lit(0), F.size("doc_id") - 1)).alias("i"))
        .selectExpr("doc_id[i] AS doc_id", "start[i] AS start", "count[i] AS length", "doc_tokens[i] AS doc_tokens",
                    "sequence_id", f"{before} AS offset", "ids")
        .selectExpr("doc_id", "start", "length",
                    "crc32(substring(ids, CAST(offset AS INT) * 4 + 1, CAST(length AS INT) * 4)) AS ids_crc32",
                    "doc_tokens", "sequence_id", "offset")
    )
