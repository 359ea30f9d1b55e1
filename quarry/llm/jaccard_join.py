"""N-gram Jaccard join by parity sketches: components of documents whose shingle sets are similar.

A document's set holds the hashes of its 5-word shingles. Two sets A, B with
``|A n B| >= 0.8 |A u B|`` differ in at most ``(|A| + |B|) / 9`` hashes, and each lacks
at most a fifth of its own in the other. The join finds all such pairs:

1. Sets are fingerprinted; equal sets become one node.
2. A node can link only if at most a fifth of its hashes occur in no other
   document. This is counted for the half of all hashes with an even value:
   hashes go, packed by document, to buckets of the hash space, which return how
   many of each document stand alone. Documents that share no text end here.
3. Parity sketch: within a size band, each hash of a set flips one bit of a
   sketch of m blocks, far wider than it has hashes, so that the Hamming
   distance of two sketches is at most the symmetric difference. A block is kept as the
   XOR of its hashes. With m above the most differing hashes d of the
   band, two similar sets agree in at least m - d blocks (pigeonhole). Blocks
   without a bit are no key; a set with m - d of them or more could agree in
   nothing else, and goes on to the sketch of the next seed, as would its partner.
   Of a pair, one in the lower band decides; sets join their own band and the one below.
4. Nodes that share a block, directly or over others, are a family. Its members are compared by size and by
   a parity sketch of ``SKETCH_BITS`` bits, and then exactly; of the similar pairs only as
   many are kept as connect the members. A family of more than ``BLOCK_NODES`` nodes or ``BLOCK_HASHES``
   hashes is cut into blocks, each kept once as a file, and all pairs of blocks are dealt over tasks: no bucket is capped.

The result has the smallest doc_id reachable over links for every document.
Defined results: texts without words (null, empty) have an empty set and are linked with
nothing; with fewer than five words the whole sequence is the one shingle;
repeated rows link with each other; rows without doc_id link with nothing and
have a null component; very long texts are read whole; an empty table gives no row;
other columns are ignored.
Hashes are 64 bits wide; equal hashes count as equal shingles.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import _bytes, _store
from quarry.llm._components import components

SHINGLE = _bytes.SHINGLE_WORDS
PERCENT = 80
BUCKET_HASHES = 2_000_000
CHUNK_HASHES = 4_000_000
MOST_CHUNK_DOCS = 1 << 16
SEEDS = 64
SKETCH_BITS = 1024
BLOCK_NODES = 4096
BLOCK_HASHES = 4_000_000
HEAD_WORDS = 8
QUARTER = np.uint64(1 << 62)
MOST_TASKS = 4096
LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each row, one after the other, and the first of each row (with an end)."""
    words, rows = _bytes.words(data, offsets, lower=True)
    hashes, _, at = _bytes.windows(words, rows, SHINGLE)
    n_words = np.diff(rows)
    few = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    if len(few):  # the whole sequence as one; the number of words keeps it apart from longer windows
        whole = []
        for r in few:
            w = words[rows[r]:rows[r + 1]]
            whole.append(_bytes.mix((w * _bytes._COMBINE[:len(w)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(w)))[0])
        hashes = np.concatenate([hashes, np.array(whole, np.uint64)])
        row = np.concatenate([row, few])
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[new], row[new]
    return hashes, np.searchsorted(row, np.arange(len(offsets)))


def fingerprints(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for the empty set only."""
    out = np.zeros(len(at) - 1, np.uint64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        a = np.add.reduceat(_bytes.mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), at[some])
        b = np.bitwise_xor.reduceat(hashes, at[some])
        out[some] = np.maximum(_bytes.mix(_bytes.mix(a) + b * np.uint64(3) + np.diff(at)[some].astype(np.uint64)), np.uint64(1))
    return out


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def nodes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, n, node) of every document; node is null for an empty set."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in _bytes.row_blocks(batch.column("text")):
                hashes, at = shingle_sets(data, offsets)
                node = fingerprints(hashes, at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(np.diff(at), pa.int64()),
                     pa.array(node.view(np.int64), pa.int64(), mask=node == 0)], ["doc_id", "n", "node"])

    return _source(docs).mapInArrow(sets, "doc_id long, n long, node long")


def may_link(docs: DataFrame, n_hashes: int) -> DataFrame:
    """(node): the sets of which at most a fifth of the hashes occur in no other document, as far as the counted
    half of the hashes tells."""
    bits = max(0, (n_hashes // 2 // BUCKET_HASHES).bit_length())
    buckets = 1 << bits

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        hashes, docs_of, nodes, sizes = [], [], [], []
        n_docs = n_rows = 0

        def flush():
            nonlocal chunk, hashes, docs_of, nodes, sizes, n_docs, n_rows
            h, d = np.concatenate(hashes), np.concatenate(docs_of)
            b = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
            order = np.argsort(b, kind="stable")
            h = (h[order] >> np.uint64(max(0, 32 - bits))).astype(np.uint32)  # 32 bits below those of the bucket
            d = d[order].astype(np.uint16)
            stops = np.searchsorted(b[order], np.arange(buckets + 1))
            rows = [(int(k), chunk, h[s:e].tobytes(), d[s:e].tobytes()) for k, (s, e) in enumerate(zip(stops[:-1], stops[1:])) if e > s]
            rows.append((buckets + chunk % buckets, chunk, np.concatenate(nodes).tobytes(), np.concatenate(sizes).astype(np.int64).tobytes()))
            chunk += 1
            hashes, docs_of, nodes, sizes, n_docs, n_rows = [], [], [], [], 0, 0
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "chunk", "left", "right"])

        for batch in batches:
            for i, j, data, offsets in _bytes.row_blocks(batch.column("text")):
                h, at = shingle_sets(data, offsets)
                node = fingerprints(h, at)
                row = np.repeat(np.arange(j - i), np.diff(at))
                even = (h & np.uint64(1)) == 0
                if n_docs and (n_docs + j - i > MOST_CHUNK_DOCS or n_rows > CHUNK_HASHES):
                    yield flush()
                hashes.append(h[even])
                docs_of.append(row[even] + n_docs)
                nodes.append(node)
                sizes.append(np.diff(at))
                n_docs, n_rows = n_docs + j - i, n_rows + int(even.sum())
        if n_docs:
            yield flush()

    def alone(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() >= buckets:
            return table.select(["chunk", "left", "right"]).append_column("head", pa.array([True] * len(table)))
        left = [np.frombuffer(x, np.uint32) for x in table.column("left").to_pylist()]
        right = [np.frombuffer(x, np.uint16) for x in table.column("right").to_pylist()]
        every = np.concatenate(left)
        order = np.argsort(every, kind="stable")
        s = every[order]
        single = np.ones(len(s), bool)
        single[1:] &= s[1:] != s[:-1]
        single[:-1] &= s[1:] != s[:-1]
        mine = np.zeros(len(s), bool)
        mine[order] = single
        out, k = [], 0
        for x in right:
            count = np.bincount(x[mine[k:k + len(x)]])
            k += len(x)
            seen = np.flatnonzero(count)
            out.append((seen.astype(np.uint16).tobytes(), count[seen].astype(np.uint32).tobytes()))
        return pa.table({"chunk": table.column("chunk"), "left": pa.array([x[0] for x in out], pa.binary()),
                         "right": pa.array([x[1] for x in out], pa.binary()), "head": pa.array([False] * len(out))})

    def judge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        (head,) = [r for r in rows if r["head"]]
        nodes, sizes = np.frombuffer(head["left"], np.int64), np.frombuffer(head["right"], np.int64)
        lone = np.zeros(len(nodes), np.int64)
        for r in rows:
            if not r["head"]:
                np.add.at(lone, np.frombuffer(r["left"], np.uint16), np.frombuffer(r["right"], np.uint32).astype(np.int64))
        stay = (100 * lone <= (100 - PERCENT) * sizes) & (sizes > 0)
        return pa.table({"node": pa.array(np.unique(nodes[stay]), pa.int64())})

    return (_source(docs).where("doc_id IS NOT NULL").select("text")
            .mapInArrow(deal, "bucket long, chunk long, left binary, right binary")
            .groupBy("bucket").applyInArrow(alone, "chunk long, left binary, right binary, head boolean")
            .groupBy("chunk").applyInArrow(judge, "node long").distinct())


def bands(most: int) -> np.ndarray:
    """Largest set size of each size band; each is at most 5/4 of the one before (or one more)."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4))
    return np.array(out, np.int64)


def block_keys(hashes: np.ndarray, all_bands: np.ndarray) -> np.ndarray:
    """Keys of the filled blocks of a set's sketches in its own size band and the one below."""
    n = len(hashes)
    own = int(np.searchsorted(all_bands, n))
    keys = []
    for band in (own - 1, own):
        if band < 0 or 100 * int(all_bands[band]) < PERCENT * n:
            continue  # every smaller partner is in a higher band
        most = int(all_bands[band])
        # |A| <= most and |B| <= |A| / 0.8, so they differ in at most (|A| + |B|) / 9 hashes
        d = most // 4
        m = d + 3 + d // 4
        for seed in range(SEEDS):
            h = _bytes.mix(hashes + np.uint64((0x9E3779B97F4A7C15 * (seed + 1) + 0x1234567) & (2 ** 64 - 1)))
            block = (h % np.uint64(m)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            b = block[order]
            first = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            parity = np.bitwise_xor.reduceat(_bytes.mix(h[order]), first)
            scheme = np.uint64((band * SEEDS + seed) * 0xA0761D6478BD642F & (2 ** 64 - 1))
            keys.append(_bytes.mix((parity ^ scheme) + b[first].astype(np.uint64)))
            if m - len(first) < m - d:
                break
        else:
            raise ValueError("no seed fills the blocks of a set")  # needs d + 1 filled blocks of about n hashes
    return np.concatenate(keys)


def sets_of(spark: SparkSession, docs: DataFrame, picked: DataFrame) -> DataFrame:
    """(node, n, hashes) of the picked (doc_id, node)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for i, j, data, offsets in _bytes.row_blocks(batch.column("text")):
                hashes, at = shingle_sets(data, offsets)
                same = np.flatnonzero(fingerprints(hashes, at).view(np.int64) == nodes[i:j])
                if len(same):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[i:j][same]), pa.array(np.diff(at)[same]),
                         pa.array([hashes[at[k]:at[k + 1]].tobytes() for k in same], pa.binary())], ["node", "n", "hashes"])

    return _store.written(spark, _source(docs).join(picked, "doc_id").select("node", "text")
                          .mapInArrow(sets, "node long, n long, hashes binary"), "sets")


def candidates(spark: SparkSession, sets: DataFrame) -> DataFrame:
    """(a, b): every node with the smallest node of each block key that it shares with others."""
    most = sets.agg(F.max("n")).first()[0] or 1
    all_bands = bands(most)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, out = batch.column("node").to_numpy(), []
            for h in batch.column("hashes").to_pylist():
                out.append(block_keys(np.frombuffer(h, np.uint64), all_bands).view(np.int64))
            many = [len(x) for x in out]
            if many:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out)), pa.array(np.repeat(nodes, many))], ["key", "node"])

    keys = sets.select("node", "hashes").mapInArrow(keyed, "key long, node long")
    first = _store.written(spark, keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
                           .where("lo < hi").select("key", "lo"), "shared-keys")
    return _store.written(spark, keys.join(first, "key").where("node <> lo")
                          .select(F.col("node").alias("a"), F.col("lo").alias("b")).distinct(), "candidates")


def sketches(hashes: list[np.ndarray]) -> np.ndarray:
    """Parity sketch of SKETCH_BITS bits of each set: every hash flips one bit."""
    words = SKETCH_BITS // 64
    out = np.zeros(len(hashes) * words, np.uint64)
    flat = _bytes.mix(np.concatenate(hashes) ^ np.uint64(0x2545F4914F6CDD1D))
    row = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    np.bitwise_xor.at(out, row * words + ((flat >> np.uint64(6)) % np.uint64(words)).astype(np.int64),
                      np.uint64(1) << (flat & np.uint64(63)))
    return out.reshape(len(hashes), words)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """How many hashes two sorted sets share."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum()) if len(x) else 0


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(x) + len(y) > 256:
        # what differs in the lowest quarter of the hashes is a lower bound, which most pairs exceed that are not similar
        a, b = x[:np.searchsorted(x, QUARTER)], y[:np.searchsorted(y, QUARTER)]
        if (len(a) + len(b) - 2 * _common(a, b)) * (100 + PERCENT) > (len(x) + len(y)) * (100 - PERCENT):
            return False
    both = _common(x, y)
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def spanning_links(hashes: list[np.ndarray], side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Similar pairs that connect just what all similar pairs connect (with ``side``: pairs of unequal sides only)."""
    return _spanning(np.array([len(h) for h in hashes]), sketches(hashes), hashes.__getitem__, side)


def _near_pairs(n: np.ndarray, sketch: np.ndarray, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes, ordered by size n, whose sizes and sketches are not too far apart."""
    last = np.searchsorted(n, n * 100 // PERCENT, "right")
    kind = np.zeros(len(n), int) if side is None else np.unique(side, return_inverse=True)[1]
    i_of, j_of = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for k in range(kind.max(initial=-1) + 1):
        mine = np.flatnonzero(kind == k)
        rest = mine if side is None else np.flatnonzero(kind != k)
        rest_n, words = n[rest], np.ascontiguousarray(sketch[rest].T)
        for i, first, end in zip(mine.tolist(), np.searchsorted(rest, mine, "right").tolist(), np.searchsorted(rest, last[mine]).tolist()):
            if first >= end:
                continue
            most = (n[i] + rest_n[first:end]) * (100 - PERCENT)
            own = sketch[i][:, None]
            # the distance in some of the words is a lower bound, which most pairs exceed
            distance = np.bitwise_count(words[:HEAD_WORDS, first:end] ^ own[:HEAD_WORDS]).sum(0, dtype=np.uint16)
            j = np.flatnonzero(distance.astype(np.int64) * (100 + PERCENT) <= most)
            if not len(j):
                continue
            distance = distance[j].astype(np.int64) + np.bitwise_count(words[HEAD_WORDS:, first + j] ^ own[HEAD_WORDS:]).sum(0, dtype=np.int64)
            j = rest[first + j[distance * (100 + PERCENT) <= most[j]]]
            i_of.append(np.full(len(j), i, np.int32))
            j_of.append(j.astype(np.int32))
    return np.concatenate(i_of), np.concatenate(j_of)


def _spanning(sizes: np.ndarray, sketch: np.ndarray, hashes_of: Callable[[int], np.ndarray],
              side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """:func:`spanning_links` of nodes whose sets are asked for only where they are compared exactly.

    Pairs whose sizes or sketches are too far apart are dropped; of the others, the node in most of them is
    verified first, and pairs that are connected by then need no check."""
    order = np.argsort(sizes, kind="stable")
    i, j = _near_pairs(sizes[order], sketch[order], side[order] if side is not None else None)
    links: list[tuple[int, int]] = []
    label = np.arange(len(sizes))
    while len(i):
        hub = int(np.argmax(np.bincount(i, minlength=len(label)) + np.bincount(j, minlength=len(label))))
        mine = (i == hub) | (j == hub)
        for other in np.where(i[mine] == hub, j[mine], i[mine]).tolist():
            if label[other] != label[hub] and similar(hashes_of(int(order[hub])), hashes_of(int(order[other]))):
                links.append((int(order[hub]), int(order[other])))
                label[label == label[other]] = label[hub]
        rest = ~mine
        i, j = i[rest], j[rest]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return links


def _put_block(uri: str, nodes: np.ndarray, hashes: list[np.ndarray]) -> None:
    """A block as two files: nodes, sizes and sketches; and the sets, one after the other."""
    sizes = np.array([len(h) for h in hashes], np.int64)
    _store.put(f"{uri}.sets", b"".join(h.tobytes() for h in hashes))
    _store.put(f"{uri}.heads", np.concatenate([nodes.view(np.uint64), sizes.view(np.uint64), sketches(hashes).ravel()]).tobytes())


def _heads(uri: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, sizes and sketches of a block."""
    raw = np.frombuffer(_store.get(f"{uri}.heads"), np.uint64)
    words = SKETCH_BITS // 64
    m = len(raw) // (words + 2)
    return raw[:m].view(np.int64), raw[m:2 * m].view(np.int64), raw[2 * m:].reshape(m, words)


def _block_links(uris: list[str]) -> Iterator[tuple[int, int]]:
    """Links within one block, or between two; only sets that are compared exactly are read, each once."""
    heads = [_heads(u) for u in uris]
    nodes, sizes, sketch = (np.concatenate(x) for x in zip(*heads))
    side = np.repeat(np.arange(len(heads)), [len(h[0]) for h in heads])
    at = np.concatenate([np.cumsum(h[1]) - h[1] for h in heads])
    with contextlib.ExitStack() as stack:
        files = {}

        @functools.cache
        def hashes_of(k: int) -> np.ndarray:
            s = int(side[k])
            if s not in files:
                files[s] = stack.enter_context(_store.opened(f"{uris[s]}.sets"))
            return np.frombuffer(files[s].read_at(8 * int(sizes[k]), 8 * int(at[k])), np.uint64)

        for a, b in _spanning(sizes, sketch, hashes_of, side if len(uris) > 1 else None):
            yield int(nodes[a]), int(nodes[b])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, np.ndarray, list[np.ndarray]]]:
    """Key, nodes and sets of each run of rows of one key."""
    key, nodes, sets = None, [], []
    for batch in batches:
        for *k, node, raw in zip(*(batch.column(c).to_pylist() for c in [*keys, "node", "hashes"])):
            if k != key and nodes:
                yield tuple(key), np.array(nodes, np.int64), sets
                nodes, sets = [], []
            key = k
            nodes.append(node)
            sets.append(np.frombuffer(raw, np.uint64))
    if nodes:
        yield tuple(key), np.array(nodes, np.int64), sets


def similar_links(spark: SparkSession, sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect exactly the nodes which similar pairs connect."""
    family = components(spark, candidates(spark, sets))
    # families of many nodes or bytes are cut into blocks, and each pair of blocks is a row of its own
    size = family.join(sets.select("node", "n"), "node").groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("hashes"))
    cut = F.greatest(F.ceil(F.col("m") / BLOCK_NODES), F.ceil(F.col("hashes") / BLOCK_HASHES)).cast("int")
    size = _store.written(spark, size.select("component", cut.alias("blocks")), "families")
    member = _store.written(spark, family.join(size, "component"), "family-nodes")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    placed = sets.select("node", "hashes").join(member, "node").select("component", "blocks", own.alias("block"), "node", "hashes")
    # a block of a cut family is kept once, in the shared folder, and not copied for each of its pairs
    folder = _store.shared_uri(spark, "blocks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links (a, b, null) of whole families; (component, null, block) of each block that is kept."""
        def found():
            for (component, blocks, block), nodes, hashes in _groups(batches, ["component", "blocks", "block"]):
                if blocks > 1:
                    _put_block(f"{folder}/{component}_{block}", nodes, hashes)
                    yield component, None, block
                    continue
                for a, b in spanning_links(hashes):
                    yield int(nodes[a]), int(nodes[b]), None

        yield from _store.batches(found(), LINK.append(pa.field("block", pa.int32())))

    found = _store.written(spark, placed.repartition("component", "block").sortWithinPartitions("component", "block", "node")
                           .mapInArrow(compare, "a long, b long, block int"), "similar")
    within = found.where("block IS NULL").select("a", "b")
    blocks = found.where("block IS NOT NULL").select(F.col("a").alias("component"), "block")
    if blocks.isEmpty():
        return within
    pairs = _store.written(spark, blocks.select("component", F.col("block").alias("i")).join(
        blocks.select("component", F.col("block").alias("j")), "component").where("i <= j"), "block-pairs")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links():
            for batch in batches:
                for component, i, j in zip(*(batch.column(c).to_pylist() for c in ("component", "i", "j"))):
                    yield from _block_links([f"{folder}/{component}_{b}" for b in sorted({i, j})])

        yield from _store.batches(links(), LINK)

    # few bytes, much work: dealt evenly over a fixed number of tasks, which are not merged by their size
    tasks = min(pairs.count(), MOST_TASKS)
    return within.unionByName(_store.written(spark, pairs.repartition(tasks).mapInArrow(across, "a long, b long"), "similar"))


def similar_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    nodes = _store.written(spark, nodes_of(docs), "nodes")
    named = nodes.where("doc_id IS NOT NULL AND node IS NOT NULL")
    total = named.agg(F.sum("n")).first()[0] or 0
    classes = named.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    picked = classes.join(may_link(docs, total), "node", "left_semi").select("doc_id", "node")
    sets = sets_of(spark, docs, picked)
    groups = components(spark, similar_links(spark, sets))
    # a node's component is named by the smallest doc_id of its documents
    of_node = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of_node = _store.written(spark, of_node, "node-components")
    smallest = of_node.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = _store.written(spark, of_node.join(smallest, "component").select("node", "component_id"), "component-ids")
    return nodes.join(of_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each component (the one with the smallest doc_id), in all its columns. Rows that
    repeat a doc_id and its text are one document; rows without doc_id or without words all stay."""
    found = similar_components(spark, docs)
    copy = _store.spare(docs, "copy")
    away = _store.written(spark, found.where("doc_id <> component_id").select(F.col("doc_id").alias(copy)).distinct(), "copies")
    rest = docs.join(away, docs["doc_id"].cast("long") == F.col(copy), "left_anti")
    linked = F.col("doc_id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return rest.where(F.coalesce(linked, F.lit(False))).dropDuplicates(["doc_id", "text"]).unionByName(
        rest.where(~F.coalesce(linked, F.lit(False))))
