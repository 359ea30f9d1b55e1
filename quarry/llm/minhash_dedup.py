"""MinHash near-dedup by fast similarity sketching: banded sketches, links confirmed on full sets, components.

A document's set holds the hashes of its word shingles. Its sketch has ``BANDS * ROWS`` coordinates, filled in
rounds of hashed bin placement: in each of the first T rounds every element falls into one hashed bin; in
the T rounds after, round T + j puts every element into bin j, so that no coordinate stays
empty. A coordinate keeps the smallest (round, hash) that reached it, and a set is done after the round that
fills its last bin: large sets after one or two rounds, at a cost of T log T + n instead of T * n. Two
sets agree in a coordinate with a chance of their similarity s, and the number of agreeing ones
is as concentrated as that of T independent hashes, also for sets far smaller than T.

1. Equal sets become one node. Coordinates are cut into BANDS bands of ROWS; each gives a key.
   Two sets of similarity 0.8 share no key with a chance of (1 - 0.8 ** ROWS) ** BANDS, 1.4e-7.
2. Every node is confirmed against the smallest node of each of its keys, on the full sets: as many pairs as
   nodes with keys, however many share one. A node's label is the smallest node that it is linked with so, or itself.
3. A key of which all nodes have one label, or that has two nodes, is settled. The nodes of the others, joined over
   their keys, form families; there every pair that shares a key and has different labels is confirmed as well. Families
   are cut into blocks of ``BLOCK_NODES`` nodes, a task for each two blocks, so that no key or family is capped.

Hashes are 64 bits wide; equal hashes count as equal shingles.

Defined results: null, empty and wordless texts have an empty set, linked with nothing; a text with fewer words than a
shingle is one shingle as a whole; texts of any length are read whole, in blocks; rows that repeat a doc_id
are rows of the result each, and equal sets are linked; a null doc_id is linked with nothing and kept; other columns, whatever their
names, are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import _bytes, _filter, _store
from quarry.llm._components import components

SHINGLE = 2
PERCENT = 80
ROWS = 6
BANDS = 52
BLOCK_NODES = 1024

_NONE = np.uint64(2 ** 64 - 1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after the other, and the first of each row (with an end)."""
    words, rows = _bytes.words(data, offsets, lower=True)
    n_rows = len(offsets) - 1
    parts, owners = [], []
    for width in range(1, shingle + 1):  # rows with fewer words than a shingle: all their words, as a wider window would be
        hashes, begin, at = _bytes.windows(words, rows, width)
        row = np.repeat(np.arange(n_rows), np.diff(at))
        if width < shingle:
            own = np.diff(rows)[row] == width
            hashes, row = hashes[own], row[own]
        parts.append(_bytes.mix(hashes + np.uint64(width)))
        owners.append(row)
    hashes, row = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[new], row[new]
    return hashes, np.searchsorted(row, np.arange(n_rows + 1))


def set_names(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for the empty one only."""
    out = np.zeros(len(at) - 1, np.uint64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        total = np.add.reduceat(_bytes.mix(hashes ^ np.uint64(0xA24BAED4963EE407)), at[some])
        out[some] = np.maximum(_bytes.mix(total ^ np.diff(at)[some].astype(np.uint64)), np.uint64(1))
    return out


def sketches(hashes: np.ndarray, at: np.ndarray, size: int = ROWS * BANDS) -> np.ndarray:
    """The sketch of each non-empty set: ``size`` coordinates, all filled."""
    n = len(at) - 1
    out = np.full((n, size), _NONE, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(at))
    element = hashes
    for turn in range(2 * size):
        if not len(element):
            break
        seed = np.uint64((0x9E3779B97F4A7C15 * (turn + 1) + 0x5851F42D4C957F2D) & (2 ** 64 - 1))
        h = _bytes.mix(element + seed)
        value = (np.uint64(turn) << np.uint64(48)) | (_bytes.mix(h ^ seed) >> np.uint64(16))
        if turn < size:
            bins = (((h >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)
        else:
            bins = turn - size
        np.minimum.at(flat, owner * size + bins, value)
        left = np.flatnonzero((out == _NONE).any(1)) if turn == 0 else left[(out[left] == _NONE).any(1)]
        unfilled = np.zeros(n, bool)
        unfilled[left] = True
        on = unfilled[owner]
        if not on.all():
            owner, element = owner[on], element[on]
    return out


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(sets, bands) keys of the bands of a sketch."""
    bands = sketch.shape[1] // rows
    cut = _bytes.mix(sketch).reshape(len(sketch), bands, rows)
    total = (cut * _bytes._COMBINE[:rows]).sum(2, dtype=np.uint64)
    return _bytes.mix(total + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def least_size(percent: int = PERCENT) -> int:
    """The smallest set that can be linked with a different one: with one of its size and one more."""
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def sketched(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc_id, n, node, keys) of every document; node is null for an empty set, keys for one that cannot link."""
    least = least_size(percent)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in _bytes.row_blocks(batch.column("text")):
                hashes, at = shingle_sets(data, offsets, shingle)
                size = np.diff(at)
                node = set_names(hashes, at)
                big = size >= least
                inside = np.repeat(big, size)
                keys = band_keys(sketches(hashes[inside], np.append(0, np.cumsum(size[big]))))
                begins = np.append(0, np.cumsum(np.where(big, BANDS, 0)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(size, pa.int64()),
                     pa.array(node.view(np.int64), pa.int64(), mask=node == 0),
                     pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))],
                    ["doc_id", "n", "node", "keys"])

    return _source(docs).mapInArrow(keyed, "doc_id long, n long, node long, keys array<long>")


def sets_of(spark: SparkSession, docs: DataFrame, picked: DataFrame, shingle: int) -> DataFrame:
    """(node, n, hashes) of the picked (doc_id, node). A bounded Bloom filter keeps the other texts from being read;
    the join after it is exact."""
    shared = spark.sparkContext.broadcast(_filter.bloom(picked.select(F.xxhash64("doc_id").alias("hash"))))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.sort(_filter.inside(shared.value, batch.column("hash").to_numpy().view(np.uint64)))
            some = batch.take(pa.array(at))
            for i, j, data, offsets in _bytes.row_blocks(some.column("text")):
                hashes, begin = shingle_sets(data, offsets, shingle)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id").slice(i, j - i), pa.array(set_names(hashes, begin).view(np.int64)), pa.array(np.diff(begin), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(hashes.view(np.int64)))],
                    ["doc_id", "node", "n", "hashes"])

    table = _source(docs).where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("doc_id").alias("hash")).mapInArrow(
        sets, "doc_id long, node long, n long, hashes array<long>")
    table = _store.written(spark, table, "minhash-maybe").join(picked, ["doc_id", "node"], "left_semi")
    return _store.written(spark, table.dropDuplicates(["node"]).select("node", "n", "hashes"), "minhash-sets")


def confirmed(spark: SparkSession, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    return _store.written(spark, pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", both.alias("both"))
                          .where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b"), "minhash-links")


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def family_links(rows: list[tuple], cross: bool, percent: int) -> Iterator[tuple[int, int]]:
    """Links between nodes (side, node, label, keys, hashes) of different labels that share a key; of
    ``cross`` blocks only over the sides. Labels that a link has joined are not compared again."""
    label = np.array([r[2] for r in rows])
    side = np.array([r[0] for r in rows])
    keys = np.array([r[3] for r in rows])
    size = np.array([len(r[4]) for r in rows])
    sets: list = [None] * len(rows)

    def set_of(k):
        if sets[k] is None:
            sets[k] = np.sort(np.array(rows[k][4], np.int64))
        return sets[k]

    for i in range(len(rows) - 1):
        rest = slice(i + 1, len(rows))
        near = (label[rest] != label[i]) & (100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i]))
        if cross:
            near &= side[rest] != side[i]
        at = np.flatnonzero(near) + i + 1
        for j in at[(keys[at] == keys[i]).any(1)].tolist():
            if label[j] != label[i] and _alike(set_of(i), set_of(j), percent):
                yield rows[i][1], rows[j][1]
                label[label == label[j]] = label[i]


def rest_links(spark: SparkSession, members: DataFrame, reps: DataFrame, sets: DataFrame, links: DataFrame, percent: int) -> DataFrame | None:
    """Links between differently labelled nodes of keys with three nodes or more, as far as they connect labels."""
    labels = _store.written(spark, links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "minhash-labels")
    labelled = members.where("c > 2").join(labels, "node", "left").select("key", "node", "lo", F.coalesce("label", "node").alias("label"))
    labelled = _store.written(spark, labelled, "minhash-labelled")
    unsettled = _store.written(spark, labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
                               .where("x < y").select("key"), "minhash-unsettled")
    if unsettled.isEmpty():
        return None
    stars = _store.written(spark, labelled.join(unsettled, "key").where("node <> lo")
                           .select(F.col("node").alias("a"), F.col("lo").alias("b")).distinct(), "minhash-stars")
    family = _store.written(spark, components(spark, stars), "minhash-families")
    blocks = _store.written(spark, family.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK_NODES).cast("int").alias("blocks")), "minhash-blocks")
    placed = (family.join(blocks, "component").join(labels, "node", "left")
              .withColumn("label", F.coalesce("label", "node")).withColumn("side", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
              .join(reps.select("node", "keys"), "node").join(sets.select("node", "hashes"), "node")
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("component", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "label", "keys", "hashes"))
    names = ("side", "node", "label", "keys", "hashes")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            key, rows = None, []
            for batch in batches:
                for k, row in zip(zip(*(batch.column(c).to_pylist() for c in ("component", "i", "j"))),
                                  zip(*(_values(batch.column(c)) for c in names))):
                    if k != key and rows:
                        yield from family_links(rows, key[1] != key[2], percent)
                        rows = []
                    key = k
                    rows.append(row)
            if rows:
                yield from family_links(rows, key[1] != key[2], percent)

        yield from _store.batches(found(), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return _store.written(spark, placed.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
                          .mapInArrow(compare, "a long, b long"), "minhash-rest")


def _values(column: pa.Array) -> list:
    """Values of a column; lists as numpy arrays."""
    if not pa.types.is_list(column.type) and not pa.types.is_large_list(column.type):
        return column.to_pylist()
    flat, begin = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[s:e] for s, e in zip(begin[:-1], begin[1:])]


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    table = _store.written(spark, sketched(docs, shingle, percent), "minhash-sketches")
    named = table.where("doc_id IS NOT NULL AND node IS NOT NULL")
    reps = _store.written(spark, named.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("keys").alias("keys")),
                          "minhash-nodes")
    keyed = reps.select("node", "n", F.explode("keys").alias("key"))
    shared = _store.written(spark, keyed.groupBy("key").agg(F.min(F.struct("node", "n")).alias("lo"), F.count(F.lit(1)).alias("c"))
                            .where("c > 1").select("key", F.col("lo.node").alias("lo"), F.col("lo.n").alias("lo_n"), "c"), "minhash-keys")
    members = _store.written(spark, keyed.join(shared, "key"), "minhash-members")
    near = 100 * F.least("n", "lo_n") >= percent * F.greatest("n", "lo_n")
    pairs = _store.written(spark, members.where((F.col("node") != F.col("lo")) & near)
                           .select(F.col("node").alias("a"), F.col("lo").alias("b")).distinct(), "minhash-pairs")
    picked = _store.written(spark, reps.join(members.select("node").distinct(), "node", "left_semi").select("doc_id", "node"), "minhash-picked")
    sets = sets_of(spark, docs, picked, shingle)
    links = confirmed(spark, pairs, sets, percent)
    more = rest_links(spark, members, reps, sets, links, percent)
    groups = components(spark, links if more is None else links.unionByName(more))
    of_node = _store.written(spark, reps.select("node", "doc_id").join(groups, "node", "left")
                             .select("node", "doc_id", F.coalesce("component", "node").alias("component")), "minhash-components")
    smallest = of_node.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = _store.written(spark, of_node.join(smallest, "component").select("node", "component_id"), "minhash-ids")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return table.select("doc_id", "n", "node").join(of_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, shingle: int = 5, percent: int = PERCENT) -> DataFrame:
    """The documents that :func:`near_duplicates` keeps, in all their columns; a repeated doc_id with its text is one."""
    found = near_duplicates(spark, docs, shingle, percent)
    copy = _store.spare(docs, "copy")
    away = _store.written(spark, found.where("NOT kept").select(F.col("doc_id").alias(copy)).distinct(), "minhash-copies")
    rest = docs.join(away, F.col("doc_id").cast("long") == F.col(copy), "left_anti")
    named = F.coalesce(F.col("doc_id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return rest.where(named).dropDuplicates(["doc_id", "text"]).unionByName(rest.where(~named))
