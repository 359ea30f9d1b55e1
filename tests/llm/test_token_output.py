"""Token-id files (operator 7)."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_cases import no_docs, odd_docs, odd_rows
from quarry.llm import _store, token_output

WORD = public_tokenizers.path("word_bpe_49k.json")


def expected(docs):
    plain = Tokenizer.from_file(WORD)
    return [(i, np.array(plain.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for i, t, *_ in docs]


def test_round_trip_of_odd_documents(spark):
    rows = token_output.ids_by_document(spark, odd_docs(spark), WORD).collect()
    want = expected(odd_rows())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == sorted(
        (i is not None, i or 0, len(x), zlib.crc32(x.tobytes())) for i, x in want)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows if r.doc_id is not None] == sorted(i for i, _ in want if i is not None)
    end = 0
    for r in rows:
        assert r.start == end
        end += r.n_tokens


def test_one_document_is_read_by_its_index(spark):
    folder = _store.shared_uri(spark, "ids-test")
    shards = token_output.write_ids(spark, odd_docs(spark), WORD, folder).collect()
    want = dict(expected(odd_rows()))
    found = {}
    for s in shards:
        for doc in (9, 13, 2 ** 62, 2):
            ids = token_output.read_document(folder, s.shard, doc)
            if ids is not None:
                found[doc] = ids
    assert sorted(found) == [2, 9, 13, 2 ** 62]
    for doc, ids in found.items():
        assert ids.tolist() == want[doc].tolist()
    assert token_output.read_document(folder, shards[0].shard, 123456) is None


def test_a_shard_names_its_dictionary():
    shard = token_output.encode_shard([(5, b"abc", 2, True), (None, b"", 0, True)], b"one")
    index = token_output.shard_index(shard, b"one")
    assert index["doc_id"].tolist() == [5, 0] and index["flags"].tolist() == [2, 3] and index["end"].tolist() == [3, 3]
    with pytest.raises(ValueError):
        token_output.shard_index(shard, b"other")
    with pytest.raises(ValueError):
        token_output.shard_index(b"x" * 60, b"one")


def test_empty_table(spark):
    assert token_output.ids_by_document(spark, no_docs(spark), WORD).collect() == []


def test_sample_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = token_output.ids_by_document(spark, docs, WORD).collect()
    want = expected(sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()))
    end = 0
    for r, (i, x) in zip(sorted(rows, key=lambda r: r.doc_id), want):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, end, len(x), zlib.crc32(x.tobytes()))
        end += len(x)
