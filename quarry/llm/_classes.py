"""Characters folded to a few classes (letters, accents, capitals, digits, marks, white space): features of the classifier."""

from __future__ import annotations

import numpy as np

from quarry.llm import _bytes

CLASSES = 48


def _class_table() -> np.ndarray:
    """Class of each ASCII byte: white space 0, line feed 1, a-z 2-27, capital 28, digit 29, stops 30, other 31-32."""
    t = np.full(256, 32, np.int32)
    t[list(b"'\"-()/_")] = 31
    t[list(b".,;:!?")] = 30
    t[48:58] = 29
    t[65:91] = 28
    t[97:123] = np.arange(2, 28)
    t[list(_bytes.SPACES)] = 0
    t[0x0A] = 1
    return t


_ASCII = _class_table()


def classes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of every character, and the first character of each row (with an end entry)."""
    head = (data & 0xC0) != 0x80
    at = np.flatnonzero(head)
    b = data[at].astype(np.int32)
    out = _ASCII[b]
    wide = b >= 0x80
    if wide.any():
        where = at[wide]
        lead = b[wide]
        tail = data[np.minimum(where + 1, len(data) - 1)].astype(np.int32) & 0x3F
        cp = ((lead & 0x1F) << 6) | tail
        latin = (lead < 0xE0) & (cp >= 0xC0) & (cp < 0x100)
        out[wide] = np.where(latin & (cp < 0xDF), 28, np.where(latin, 33 + cp % 11, np.where(lead < 0xE0, 44 + cp % 2, 46 + tail % 2)))
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(head, out=seen[1:])
    return out, seen[offsets]
