"""Token ids of whole texts through the ``tokenizers`` library, each distinct word encoded once.

A text is cut at single spaces and line feeds between two visible characters.
Both kinds of tokenizer that are used here (byte-level pairs with an optional
leading space, and lower-cased words without white space) never join tokens
over such a place, so the ids of the pieces, one after the other, are the ids
of the text. Distinct pieces are found by hash and encoded together in long
strings; a bounded cache keeps their ids for the next batch of the worker.
"""

from __future__ import annotations

import os

import numpy as np

from quarry.llm import _bytes

BATCH_BYTES = 8 << 20
CACHE_PIECES = 2 << 20
JOINED_PIECES = 4096

_ready: dict[tuple[str, int], "WordTokenizer"] = {}


def tokenizer(path: str) -> "WordTokenizer":
    """The worker's tokenizer for a file (kept between tasks)."""
    key = (path, os.getpid())
    if key not in _ready:
        _ready[key] = WordTokenizer(path)
    return _ready[key]


class WordTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        # A piece that stands between joined pieces: a line feed if it is a token of its own, else a digit.
        self.keeps_space = len(self._ids("a\n b")) > len(self._ids("a b"))
        self.between, self.mark = ("\n", 0x0A) if self.keeps_space else (" 0 ", ord("0"))
        (self.mark_id,) = self._ids("\n" if self.keeps_space else "0")
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.uint32)
        self.count = np.zeros(0, np.uint16)
        self.pool = np.zeros(0, np.uint32)

    def _ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after the other, and the first id of each row (with an end entry)."""
        ids, ends = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for i, j in _bytes.blocks(offsets, BATCH_BYTES):
            part = data[offsets[i]:offsets[j]]
            got, at = self._encode(part, offsets[i:j + 1] - offsets[i])
            ids.append(got)
            ends.append(at[1:] + ends[-1][-1])
        return np.concatenate(ids), np.concatenate(ends)

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts, unsure = self._pieces(data, offsets)
        ends = np.append(starts[1:], n)
        hashes = np.concatenate([_bytes.span_hashes(data[starts[a]:ends[b - 1]], starts[a:b] - starts[a], ())
                                 for a, b in _bytes.blocks(np.append(starts, n))])
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_PIECES:
            self._forget()
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inner = at < len(self.keys)
        known[inner] = self.keys[at[inner]] == distinct[inner]
        if not known.all():
            self._learn(distinct[~known], data, starts[sample[~known]], ends[sample[~known]], unsure)
            at = np.searchsorted(self.keys, distinct)
        first, count = self.first[at].astype(np.int64)[which], self.count[at][which].astype(np.int64)
        total = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=total[1:])
        ids = self.pool[np.repeat(first - total[:-1], count) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, offsets)]

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the pieces, and a running count of bytes that keep a piece from being joined with others."""
        n = len(data)
        solid = data > 0x20
        lead = (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))  # may begin a white-space character
        if lead.any():
            solid &= ~lead
            solid[1:] &= ~lead[:-1]
            solid[2:] &= ~lead[:-2]
        cut = np.zeros(n, bool)
        cut[1:-1] = ((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) & solid[:-2] & solid[2:]
        inside = np.zeros(n + 1, bool)
        inside[offsets] = True  # rows begin here
        cut &= ~inside[:n] & ~inside[1:]
        begin = cut.copy()
        if self.keeps_space:  # a line feed is a piece of its own; a space belongs to the next piece
            feed = cut & (data == 0x0A)
            begin[1:] |= feed[:-1]
        begin |= inside[:n]
        unsure = np.zeros(n + 1, np.int32)
        np.cumsum(~solid | (data == self.mark), out=unsure[1:])
        return np.flatnonzero(begin), unsure

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, unsure: np.ndarray):
        lead = (data[starts] == 0x20) | (data[starts] == 0x0A) & (not self.keeps_space)
        joinable = (unsure[ends] == unsure[starts + lead]) & (ends > starts + lead)
        order = np.concatenate([np.flatnonzero(joinable), np.flatnonzero(~joinable)])
        many = int(joinable.sum())
        raw = data.tobytes()
        ids, counts = [], []
        texts = [raw[s:e].decode() for s, e in zip(starts[order].tolist(), ends[order].tolist())]
        for i in range(0, many, JOINED_PIECES):
            some = texts[i:min(i + JOINED_PIECES, many)]
            got = np.array(self._ids(self.between.join(some)), np.uint32)
            mark = got == self.mark_id
            stops = np.append(np.flatnonzero(mark), len(got))
            if len(stops) != len(some):
                raise ValueError("the tokenizer joined pieces over a separator")
            counts.append(np.diff(stops, prepend=-1) - 1)
            ids.append(got[~mark])
        for e in self.tok.encode_batch(texts[many:], add_special_tokens=False):
            ids.append(np.array(e.ids, np.uint32))
            counts.append(np.array([len(e.ids)], np.int64))
        count = np.concatenate(counts).astype(np.int64)
        first = len(self.pool) + np.cumsum(count) - count
        if len(count) and (count.max() >= 1 << 16 or first[-1] + count[-1] >= 1 << 32):
            self.first, self.count = self.first.astype(np.int64), self.count.astype(np.int64)  # a very long piece
        keys = keys[order]
        by = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[by])
        self.keys = np.insert(self.keys, at, keys[by])
        self.first = np.insert(self.first, at, first[by])
        self.count = np.insert(self.count, at, count[by])
        self.pool = np.concatenate([self.pool, *ids])
