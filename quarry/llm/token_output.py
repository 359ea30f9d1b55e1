"""Token ids on disk: shard files of separately compressed documents with one shared dictionary.

File format of a shard (little endian): the magic ``QIDS0001``; the SHA-256 of
the dictionary (32 bytes); the number of documents n (uint64); n index entries
(doc_id int64, payload end uint64 counted from the end of the index, ids
uint32, flags uint32: bit 0 says that doc_id is null); then the payloads, each
a zstandard frame of the document's ids as unsigned 16-bit values if every id
of the shard's vocabulary fits (flag bit 1), else 32-bit ones. The dictionary
is a file of its own beside the shards. One document is read with the index
entry and its payload alone (:func:`read_document`).

The dictionary is trained on the serialized ids of ``TRAIN_DOCUMENTS``
documents at most, those with the smallest hashes of their ids, and of each at most
``TRAIN_IDS`` ids; it only tunes the size of the files, not what they hold.

Documents are dealt by range of doc_id (equal ids by the hash of their text),
so shard order is id order. A task writes its shards under names made of its
number, each file moved into place whole: a task that runs again leaves the
same files. Null text counts as empty; null doc_ids come first; equal rows stay
separate documents; very long texts are encoded whole; an empty table gives no shard.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quarry.llm import _bytes, _store

MAGIC = b"QIDS0001"
INDEX = np.dtype([("doc_id", "<i8"), ("end", "<u8"), ("ids", "<u4"), ("flags", "<u4")])
HEAD = len(MAGIC) + 32 + 8
SHARD_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
TRAIN_DOCUMENTS = 512
TRAIN_IDS = 8192
LEVEL = 3

MANIFEST = pa.schema([("shard", pa.string()), ("part", pa.int64()), ("n_documents", pa.int64()),
                      ("n_ids", pa.int64()), ("n_bytes", pa.int64())])
READ = pa.schema([("shard", pa.string()), ("position", pa.int64()), ("doc_id", pa.int64()), ("before", pa.int64()),
                  ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> bytes:
    """Dictionary from a bounded sample of documents; empty if the sample is too small to train on."""
    import zstandard

    picked = [r[0] for r in docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCUMENTS).collect()]

    def sample(batches):
        from quarry.llm._tokens import tokenizer

        tok = tokenizer(tokenizer_path)
        for batch in batches:
            ids, at = tok.encode(*_bytes.utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array([_serial(np.append(ids[a:b], np.uint32(end_id))[:TRAIN_IDS])
                                                        for a, b in zip(at[:-1], at[1:])], pa.binary())], ["ids"])

    rows = (_source(docs).where(F.col("doc_id").isin(picked)).orderBy("doc_id").limit(TRAIN_DOCUMENTS)
            .select("text").mapInArrow(sample, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r[0]) for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def _serial(ids: np.ndarray) -> bytes:
    return ids.astype("<u2" if _narrow(ids) else "<u4").tobytes()


def _narrow(ids: np.ndarray) -> bool:
    return not len(ids) or int(ids.max()) < 1 << 16


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def encode_shard(documents: list[tuple[int | None, bytes, int, bool]], dictionary: bytes) -> bytes:
    """Bytes of a shard file from (doc_id, payload, number of ids, narrow) in order."""
    index = np.zeros(len(documents), INDEX)
    index["doc_id"] = [d[0] or 0 for d in documents]
    index["end"] = np.cumsum([len(d[1]) for d in documents], dtype=np.uint64)
    index["ids"] = [d[2] for d in documents]
    index["flags"] = [(d[0] is None) + 2 * d[3] for d in documents]
    return b"".join([MAGIC, hashlib.sha256(dictionary).digest(), struct.pack("<Q", len(documents)), index.tobytes(),
                     *(d[1] for d in documents)])


def shard_index(head: bytes, dictionary: bytes) -> np.ndarray:
    """The index entries of a shard, after a check of the magic and of the dictionary's hash."""
    if head[:8] != MAGIC:
        raise ValueError("not a shard of token ids")
    if head[8:40] != hashlib.sha256(dictionary).digest():
        raise ValueError("the shard was written with another dictionary")
    (n,) = struct.unpack("<Q", head[40:HEAD])
    return np.frombuffer(head, INDEX, n, HEAD)


def decode_payload(payload: bytes, entry, decompressor) -> np.ndarray:
    width = "<u2" if entry["flags"] & 2 else "<u4"
    return np.frombuffer(decompressor.decompress(payload), width).astype("<u4")


def read_document(folder: str, shard: str, doc_id: int) -> np.ndarray | None:
    """Ids of one document of a shard: reads the index and the document's payload, no other one."""
    import zstandard

    dictionary = _store.get(f"{folder}/dictionary.bin")
    system, path = _store.filesystem(f"{folder}/{shard}")
    with system.open_input_file(path) as f:
        head = f.read(HEAD)
        (n,) = struct.unpack("<Q", head[40:HEAD])
        index = shard_index(head + f.read(n * INDEX.itemsize), dictionary)
        found = np.flatnonzero((index["doc_id"] == doc_id) & (index["flags"] & 1 == 0))
        if not len(found):
            return None
        k = int(found[0])
        begin = int(index["end"][k - 1]) if k else 0
        f.seek(HEAD + index.nbytes + begin)
        payload = f.read(int(index["end"][k]) - begin)
    return decode_payload(payload, index[k], zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)))


def write_ids(spark: SparkSession, docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 1) -> DataFrame:
    """Write shards and dictionary to ``folder`` (a URI on storage that all executors share); returns the manifest."""
    dictionary = train_dictionary(docs, tokenizer_path, end_id)
    _store.put(f"{folder}/dictionary.bin", dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        from quarry.llm._tokens import tokenizer

        tok = tokenizer(tokenizer_path)
        press = zstandard.ZstdCompressor(LEVEL, dict_data=_dictionary(dictionary), write_content_size=True)
        part, number, documents, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal number, documents, size
            name = f"shard-{part:08d}-{number:06d}.qids"
            _store.put(f"{folder}/{name}", encode_shard(documents, dictionary))
            row = (name, part, len(documents), sum(d[2] for d in documents), size)
            number, documents, size = number + 1, [], 0
            return row

        def rows():
            nonlocal size
            for batch in batches:
                data, offsets = _bytes.utf8(batch.column("text"))
                doc_ids = batch.column("doc_id").to_pylist()
                for i, j in _bytes.blocks(offsets, 8 << 20):
                    ids, at = tok.encode(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                    for k in range(i, j):
                        own = np.append(ids[at[k - i]:at[k - i + 1]], np.uint32(end_id))
                        payload = press.compress(_serial(own))
                        documents.append((doc_ids[k], payload, len(own), _narrow(own)))
                        size += len(payload)
                        if size >= SHARD_BYTES:
                            yield flush()
            if documents:
                yield flush()

        yield from _store.batches(rows(), MANIFEST)

    tie = F.xxhash64("text")
    ordered = (_source(docs).withColumn("tie", tie).repartitionByRange("doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie"))
    rows = ordered.select("doc_id", "text").mapInArrow(
        write, "shard string, part long, n_documents long, n_ids long, n_bytes long")
    return _store.written(spark, rows, "ids-manifest")


def read_ids(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document of the files: shard, position in it, ids before it in the shard, count and checksum."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        dictionary = _store.get(f"{folder}/dictionary.bin")
        press = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

        def rows():
            for batch in batches:
                for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                    index, before, begin = shard_index(content, dictionary), 0, HEAD
                    begin += index.nbytes
                    at = 0
                    for k, e in enumerate(index):
                        ids = decode_payload(content[begin + at:begin + int(e["end"])], e, press)
                        yield (path.rsplit("/", 1)[1], k, None if e["flags"] & 1 else int(e["doc_id"]), before,
                               len(ids), zlib.crc32(ids.tobytes()))
                        at, before = int(e["end"]), before + len(ids)

        yield from _store.batches(rows(), READ)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.qids").load(folder)
    found = files.select("path", "content").mapInArrow(
        read, "shard string, position long, doc_id long, before long, n_tokens long, ids_crc32 long")
    return found


def ids_by_document(spark: SparkSession, docs: DataFrame, tokenizer_path: str, folder: str | None = None,
                    end_id: int = 1) -> DataFrame:
    """Write the files, read them back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    folder = folder or _store.shared_uri(spark, "token-ids")
    manifest = write_ids(spark, docs, tokenizer_path, folder, end_id)
    # one row per shard file: the running sum over the shards is small work
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("shard", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("shard_start"))
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return (read_ids(spark, folder, manifest).join(starts, "shard")
            .select("doc_id", (F.col("shard_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))
