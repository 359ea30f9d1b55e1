"""Conversation prefix trie: nodes of shared turn prefixes, with count-min screening before the shuffle.

A conversation is a path of turns from a textless root; a node of the trie is a distinct sequence of first turns.
Each prefix has a 128-bit digest, the XOR of its turns' hashes with their positions, so prefixes are
digested by running sums that Spark can cut anywhere, and a prefix's digest gives its parent's.

Screening: a count-min sketch of ``SKETCH_ROWS`` rows estimates how often each digest occurs. Estimates are
never too low, so an estimate of one proves that a prefix is a singleton, and with it all longer prefixes of its
conversation: such tails become nodes where they stand. Only cells that hold two or more matter for
that, so the sketch is kept as one bit per cell. Prefixes with an estimate above one go into exact grouping by digest;
a full sketch only lets more through. The sketch grows with the number of prefixes, up to ``SKETCH_BITS`` bits (32 MiB).

Sums over subtrees need no walk of the tree. Every prefix row of a conversation knows whether the conversation is its
node's smallest member (its owner). Over a subtree, ``n_convs - 1`` times the length of a node's text is the
sum over member rows that are not owners; these are the first ones of each conversation, so the sum of the rows from a depth on is a
difference of two running sums. A leaf counts once, at its owner.

No conversation is gathered: turns are numbered from a range layout with prefix counts of its partitions, running
values of a conversation are taken in chunks of ``CHUNK_TURNS``, and members that end at one node are
joined into pieces of text by ranges before the pieces are hashed in order.

Defined results: turns are ordered by turn (null first), then role and text; null role or text counts as empty; repeated rows are turns of
their own; a null conv_id is left out; other columns, whatever their names, are ignored; an empty table gives no row; texts of any length
are read whole, and only their hashes and lengths are shuffled after the first layout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from quarry.llm import _store

HEAD_EVERY = 100
HEAD_MOST = 6
CHUNK_TURNS = 1024
SKETCH_ROWS = 3
SKETCH_BITS = 1 << 28
PIECE_BYTES = 1 << 16
_PIECE_BITS = 1 << 15  # of Spark's bitmap aggregates


def numbered(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv_id, pos, x, y, chars) of every turn: its place from 0, two hashes of role and text, length in code points."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    source = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                       text("role").alias("role"), text("text").alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    laid = source.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.xxhash64("role", "text").alias("x"), F.xxhash64(F.lit(1), "text", F.lit("|"), "role").alias("y"),
        F.char_length("text").cast("long").alias("chars"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    laid = _store.written(spark, laid, "trie-turns")
    # one row for each conversation and each partition that it reaches into
    runs = laid.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = _store.written(spark, runs.select("conv_id", "part", (F.col("first") - before).alias("zero")), "trie-runs")
    return _store.written(spark, laid.join(runs, ["conv_id", "part"]).select("conv_id", (F.col("at") - F.col("zero")).alias("pos"), "x", "y", "chars"),
                          "trie-numbered")


def with_shared_heads(spark: SparkSession, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, turns) and their turns (conv_id, depth from 1, x, y, chars), each rebuilt: the first
    h turns of conversation c - c % HEAD_EVERY, then its own after its first h, with h = crc32(c) % HEAD_MOST."""
    table = numbered(spark, turns)
    own = _store.written(spark, table.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "trie-lengths")
    c = own.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % HEAD_EVERY).alias("head"),
                   (F.crc32(F.col("conv_id").cast("string")) % HEAD_MOST).alias("h"))
    lengths = own.select(F.col("conv_id").alias("head"), F.col("n").alias("head_n"))
    c = c.join(lengths, "head", "left").withColumn("k", F.least("h", F.coalesce("head_n", F.lit(0))))
    c = _store.written(spark, c.select("conv_id", "head", "h", "k", (F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("turns")), "trie-convs")
    tail = table.join(c.select("conv_id", "h", "k"), "conv_id").where("pos >= h").select(
        "conv_id", (F.col("k") + F.col("pos") - F.col("h") + 1).alias("depth"), "x", "y", "chars")
    first = table.where((F.col("pos") < HEAD_MOST - 1) & (F.col("conv_id") % HEAD_EVERY == 0)).withColumnRenamed("conv_id", "head")
    heads = c.where("k > 0").select("conv_id", "head", "k").join(first, "head").where("pos < k").select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "x", "y", "chars")
    return c.select("conv_id", "turns"), tail.unionByName(heads)


def prefixes(spark: SparkSession, convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, depth, last, d1, d2, p1, p2, chars, total) of every prefix, the root included: digests of it
    and its parent, the length of its last text and of all its texts."""
    chunk = F.floor(F.col("depth") / CHUNK_TURNS).alias("chunk")
    placed = turns.select("conv_id", "depth", F.xxhash64("depth", "x").alias("x"), F.xxhash64("y", "depth").alias("y"), "chars", chunk)
    placed = _store.written(spark, placed, "trie-placed")
    sums = placed.groupBy("conv_id", "chunk").agg(F.expr("bit_xor(x)").alias("x"), F.expr("bit_xor(y)").alias("y"), F.sum("chars").alias("chars"))
    over = "OVER (PARTITION BY conv_id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    sums = _store.written(spark, sums.select("conv_id", "chunk", *[F.expr(f"coalesce({f}({c}) {over}, 0L)").alias(f"{c}_before") for f, c in (
        ("bit_xor", "x"), ("bit_xor", "y"), ("sum", "chars"))]), "trie-chunks")
    run = "OVER (PARTITION BY conv_id, chunk ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    inner = placed.select("*", *[F.expr(f"{f}({c}) {run}").alias(f"{c}_run") for f, c in (("bit_xor", "x"), ("bit_xor", "y"), ("sum", "chars"))])
    whole = inner.join(sums, ["conv_id", "chunk"]).select(
        "conv_id", "depth", "x", "y", F.expr("x_run ^ x_before").alias("x_all"), F.expr("y_run ^ y_before").alias("y_all"),
        "chars", (F.col("chars_run") + F.col("chars_before")).alias("total"))
    whole = whole.join(convs, "conv_id")
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("x"), zero.alias("y"), zero.alias("x_all"), zero.alias("y_all"),
                        zero.alias("chars"), zero.alias("total"), "turns")
    depth, up = F.col("depth"), F.col("depth") - 1
    x_up, y_up = F.expr("x_all ^ x"), F.expr("y_all ^ y")
    return _store.written(spark, whole.unionByName(root).select(
        "conv_id", "depth", (depth == F.col("turns")).alias("last"),
        F.xxhash64(depth, "x_all", "y_all").alias("d1"), F.xxhash64("y_all", "x_all", depth, F.lit(2)).alias("d2"),
        F.xxhash64(up, x_up, y_up).alias("p1"), F.xxhash64(y_up, x_up, up, F.lit(2)).alias("p2"), "chars", "total"), "trie-prefixes")


def _cells(digest: str, bits: int) -> list[str]:
    """SQL of the cells of a digest, from 0: a row of the sketch has ``1 << bits`` of them."""
    return [f"((shiftrightunsigned({digest}, {k * 20}) & {(1 << bits) - 1}L) + {k << bits}L)" for k in range(SKETCH_ROWS)]


def crowded(table: DataFrame, digest: str = "d1") -> tuple[np.ndarray, int]:
    """Bits of the count-min cells that hold two or more, and the logarithm of a row's cells. Each
    task counts its cells before the shuffle; what reaches the driver is bounded by SKETCH_BITS."""
    rows = table.count()
    bits = 16
    while bits < 44 and 1 << bits < 8 * rows and SKETCH_ROWS << (bits + 1) <= SKETCH_BITS:
        bits += 1
    cell = F.explode(F.array(*[F.expr(c) for c in _cells(digest, bits)])).alias("cell")
    twice = table.select(cell).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pieces = (twice.select((F.col("cell") + 1).alias("slot")).groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket"))
              .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("piece")).collect())
    out = np.zeros(max(SKETCH_ROWS << bits, _PIECE_BITS) // 8 + _PIECE_BITS // 8, np.uint8)
    for r in pieces:
        begin = (r["bucket"] - 1) * (_PIECE_BITS // 8)
        out[begin:begin + _PIECE_BITS // 8] = np.frombuffer(r["piece"], np.uint8)
    return out, bits


def estimates_above_one(sketch: np.ndarray, bits: int, digests: np.ndarray) -> np.ndarray:
    """Whether every cell of a digest is crowded."""
    out = np.ones(len(digests), bool)
    for k in range(SKETCH_ROWS):
        cell = ((digests >> np.uint64(20 * k)) & np.uint64((1 << bits) - 1)).astype(np.int64) + (k << bits)
        out &= (sketch[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0
    return out


def screened(spark: SparkSession, table: DataFrame) -> DataFrame:
    """The prefixes with ``shared`` and ``parent_shared``: false where the sketch proves a singleton. The root always is shared."""
    sent = spark.sparkContext.broadcast(crowded(table.where("depth > 0")))

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, bits = sent.value
        for batch in batches:
            depth = batch.column("depth").to_numpy()
            for name, root, digest in (("shared", 0, "d1"), ("parent_shared", 1, "p1")):
                above = estimates_above_one(sketch, bits, batch.column(digest).to_numpy().view(np.uint64)) | (depth <= root)
                batch = batch.append_column(name, pa.array(above))
            yield batch

    return _store.written(spark, table.mapInArrow(
        screen, StructType([*table.schema, StructField("shared", BooleanType()), StructField("parent_shared", BooleanType())])), "trie-screened")


def ends_hashes(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """(d1, d2, ends_sha256): SHA-256 of the decimal conv_ids of (d1, d2, conv_id), ascending, joined by commas.

    Ranges of members become pieces of text first; only pieces of one node meet, and are hashed as they come."""
    order = ["d1", "d2", "conv_id"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            key, first, texts, size = None, 0, [], 0
            for batch in batches:
                for d1, d2, c in zip(*(batch.column(x).to_pylist() for x in order)):
                    if texts and ((d1, d2) != key or size > PIECE_BYTES):
                        yield *key, first, ",".join(texts)
                        texts = []
                    if not texts:
                        key, first, size = (d1, d2), c, 0
                    texts.append(str(c))
                    size += len(texts[-1]) + 1
            if texts:
                yield *key, first, ",".join(texts)

        yield from _store.batches(rows(), pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]), 256)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            key, state = None, None
            for batch in batches:
                for d1, d2, ids in zip(*(batch.column(x).to_pylist() for x in ("d1", "d2", "ids"))):
                    if key == (d1, d2):
                        state.update(b"," + ids.encode())
                        continue
                    if key:
                        yield *key, state.hexdigest()
                    key, state = (d1, d2), hashlib.sha256(ids.encode())
            if key:
                yield *key, state.hexdigest()

        yield from _store.batches(rows(), pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("ends_sha256", pa.string())]))

    laid = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "d1 long, d2 long, first long, ids string")
    laid = _store.written(spark, laid, "trie-pieces")
    return laid.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "first").select("d1", "d2", "ids").mapInArrow(
        digests, "d1 long, d2 long, ends_sha256 string")


def trie(spark: SparkSession, convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie of conversations (conv_id, turns) with turns (conv_id, depth, x, y, chars)."""
    table = screened(spark, prefixes(spark, convs, turns))
    shared, single = table.where("shared"), table.where("NOT shared")
    nodes = _store.written(spark, shared.groupBy("d1", "d2").agg(
        F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.count_if("last").alias("n_ends"),
        F.min("depth").alias("depth"), F.min("p1").alias("p1"), F.min("p2").alias("p2")), "trie-nodes")

    # member rows: which are not their node's owner, and which are the owner's at a leaf
    owned = nodes.select("d1", "d2", "owner", (F.col("n_ends") == F.col("n_convs")).alias("childless"))
    members = _store.written(spark, shared.select("conv_id", "d1", "d2", "last", "chars", "total").join(owned, ["d1", "d2"]).select(
        "conv_id", "d1", "d2", "last", "chars", "total", (F.col("conv_id") == F.col("owner")).alias("own"), "childless"), "trie-members")
    # a conversation that ends beyond its shared prefixes ends at a leaf of its own
    by_conv = _store.written(spark, members.groupBy("conv_id").agg(
        F.coalesce(F.max(F.when(~F.col("own"), F.col("total"))), F.lit(0)).alias("saved_to"),
        F.when(F.max("last"), F.max(F.col("last") & F.col("own") & F.col("childless"))).otherwise(F.lit(True)).cast("long").alias("leaf")), "trie-by-conv")
    sums = members.join(by_conv, "conv_id").groupBy("d1", "d2").agg(
        F.sum(F.greatest(F.lit(0), F.col("saved_to") - F.col("total") + F.col("chars"))).alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    children = nodes.where("depth > 0").select("p1", "p2").unionByName(single.where("parent_shared").select("p1", "p2")).groupBy(
        F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("owner").alias("parent_conv_id"))
    ends = ends_hashes(spark, shared.where("last").select("d1", "d2", "conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # a singleton that the sketch lets through may have a proven singleton as its parent, of the same conversation
    top = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "owner")).alias("parent_conv_id")
    many = (nodes.join(_store.written(spark, sums, "trie-sums"), ["d1", "d2"]).join(_store.written(spark, children, "trie-children"), ["d1", "d2"], "left")
            .join(_store.written(spark, ends, "trie-ends"), ["d1", "d2"], "left").join(parents, ["p1", "p2"], "left").select(
        F.col("owner").alias("conv_id"), "depth", top, "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    tails = single.join(parents, ["p1", "p2"], "left").select(
        "conv_id", "depth", F.when(F.col("parent_shared"), F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        one.alias("n_convs"), F.when(F.col("last"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(none)).alias("ends_sha256"))
    return many.select(columns).unionByName(tails.select(columns))


def shared_prefixes(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, each rebuilt with a shared head."""
    return trie(spark, *with_shared_heads(spark, conversations))


_CRC_STEP = "CASE WHEN {0} % 2 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
_CRC_COLUMNS = ", ".join(f"{_CRC_STEP.format(f't{k}')} AS t{k + 1}" for k in range(8))

# Plain expansion of every prefix; the table of CRC-32 is made by eight steps for each byte.
SQL = f"""
WITH RECURSIVE crc_steps AS (SELECT i, i::BIGINT AS t0, {_CRC_COLUMNS} FROM range(256) AS r(i)),
crc_table AS (SELECT list(t8 ORDER BY i) AS t FROM crc_steps),
own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (
  SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: unicode(ch)::BIGINT)),
    lambda acc, b: xor(acc >> 8, t[(xor(acc, b) % 256) + 1])), 4294967295) % {HEAD_MOST} AS h
  FROM own, crc_table),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(p.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM hashed c LEFT JOIN own p ON p.conv_id = c.conv_id - c.conv_id % {HEAD_EVERY}),
members AS (
  SELECT conv_id, d AS depth, turns[1:d] AS path, turns[1:d - 1] AS parent, len(turns) = d AS ends,
         CASE WHEN d > 0 THEN length(turns[d].x) ELSE 0 END AS chars
  FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(d)),
nodes AS (
  SELECT path, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY path, depth),
linked AS (
  SELECT n.*, CASE WHEN n.depth > 0 THEN p.conv_id END AS parent_conv_id
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.parent),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
sized AS (SELECT l.*, coalesce(k.n, 0) AS n_children FROM linked l LEFT JOIN kids k ON k.depth = l.depth AND k.parent = l.path),
subtree AS (
  SELECT m.path, m.depth, sum(s.saved) AS saved_tokens, count(*) FILTER (s.n_children = 0) AS n_leaves
  FROM sized s JOIN members m ON m.conv_id = s.conv_id AND m.depth <= s.depth GROUP BY ALL)
SELECT s.conv_id, s.depth, s.parent_conv_id, s.n_convs, s.n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
  CAST(t.saved_tokens AS BIGINT) AS saved_tokens, s.ends_sha256
FROM sized s JOIN subtree t ON t.depth = s.depth AND t.path = s.path
"""
