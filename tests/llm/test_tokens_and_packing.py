"""Token ids by distinct words, packing (operator 1)."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm_cases import no_docs, odd_docs, odd_rows, prose
from quarry.llm import _bytes, _tokens, packing

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TRICKY = ["", " ", "\n", "a\n", "\na", "  a  b \n\n c", "a 's 'll 's", "00 0 1 0 a0b", "é b", "́ ́x", "tab\tb",
          "<|endoftext|> a <|endoftext|>", "a　b   c", "ab\x00c \x1f d", "x" * 5000, "Σας ΣΑΣ", "!! ## a,b. c"]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_equal_those_of_the_whole_text(path):
    texts = TRICKY + [t or "" for _, t, _ in odd_rows()]
    tok, plain = _tokens.WordTokenizer(path), Tokenizer.from_file(path)
    for _ in range(2):  # the second time from the cache
        ids, at = tok.encode(*_bytes.utf8(pa.array(texts)))
        for k, t in enumerate(texts):
            assert ids[at[k]:at[k + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t[:40])


def test_equal_words_have_equal_hashes_and_others_not():
    data, offsets = _bytes.utf8(pa.array(["the cat", None, "cat THE the", "\t act tca "]))
    h, rows = _bytes.words(data, offsets)
    assert rows.tolist() == [0, 2, 2, 5, 7]
    assert h[0] == h[4] and h[1] == h[2] and len(set(h.tolist())) == 5
    low, _ = _bytes.words(data, offsets, lower=True)
    assert low[3] == low[0] and len(set(low.tolist())) == 4


def covered(rows, docs, capacity):
    """Checks every rule of the contract; returns the padding."""
    plain = Tokenizer.from_file(BYTE)
    ids = {}
    for i, t, *_ in docs:
        ids.setdefault(i, []).append(np.array(plain.encode(t or "", add_special_tokens=False).ids + [0], "<u4"))
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    padding = 0
    for pieces in by_sequence.values():
        end = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == end and r.length > 0
            end += r.length
        assert end <= capacity
        padding += 0 if end & (end - 1) == 0 else capacity - end
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        copies = ids[doc]
        assert sum(r.length for r in pieces) == sum(len(c) for c in copies)
        for r in pieces:
            assert any(len(c) == r.doc_tokens and zlib.crc32(c[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for c in copies)
        if len(copies) == 1:
            end = 0
            for r in sorted(pieces, key=lambda r: r.start):
                assert r.start == end
                end += r.length
    return padding


def test_odd_documents_are_packed_whole(spark):
    rows = packing.pieces(packing.pack(spark, odd_docs(spark), BYTE)).collect()
    assert covered(rows, odd_rows(), 1024) < 1024


@pytest.mark.parametrize("open_windows", [1, 3, 50])
def test_small_windows_and_many_partitions(spark, open_windows):
    docs = [(i, prose(i, 1 + i * 7 % 90), "en") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(7)
    rows = packing.pieces(packing.pack(spark, df, BYTE, capacity=64, open_windows=open_windows, max_gap=4)).collect()
    total = sum(r.length for r in rows)
    assert covered(rows, docs, 64) <= 0.08 * total


def test_packer_is_best_fit_and_bounded():
    p = packing.Packer(10, 2, 0, 0)
    a = lambda doc, n: [(doc, 0, np.arange(n, dtype=np.uint32), n)]
    assert list(p.add(a(1, 6))) == [] and list(p.add(a(2, 7))) == []
    assert [w[0] for w in p.open] == [6, 7]
    (full,) = p.add(a(3, 3))  # the fullest window that holds it
    assert full[3] == [2, 3] and full[2] == 10
    list(p.add(a(4, 5)))
    out = list(p.add(a(5, 8)))  # nothing fits: the fullest is filled up and emitted
    assert out[0][3] == [1, 5] and out[0][2] == 10 and [w[0] for w in p.open] == [9]


def test_empty_table(spark):
    assert packing.pack(spark, no_docs(spark), BYTE).count() == 0
