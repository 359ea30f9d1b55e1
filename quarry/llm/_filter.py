"""Bloom filters of 64-bit hashes: built by Spark in pieces, of bounded size, looked up with numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

MOST_BITS = 1 << 28  # 32 MiB
PROBES = 3
_PIECE = 4096


def bloom(hashes: DataFrame) -> np.ndarray:
    """Bytes of a filter of the column ``hash``; about 32 bits for each, up to MOST_BITS. A full filter lets
    everything through, so whatever uses it must stay right without it."""
    total = hashes.count()
    bits = 1 << 20
    while bits < min(32 * total, MOST_BITS):
        bits *= 2
    # the remainder by a power of two is the low bits
    slot = F.explode(F.array(*[F.expr(f"(shiftrightunsigned(hash, {20 * k}) & {bits - 1}L) + 1") for k in range(PROBES)]))
    pieces = (hashes.select(slot.alias("slot")).groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket"))
              .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("piece")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in pieces:
        out[(r["bucket"] - 1) * _PIECE:r["bucket"] * _PIECE] = np.frombuffer(r["piece"], np.uint8)
    return out


def inside(filter_bytes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the (unsigned) hashes that may be in the filter."""
    at = np.arange(len(hashes))
    bits = np.uint64(len(filter_bytes) * 8)
    for k in range(PROBES):
        slot = ((hashes[at] >> np.uint64(20 * k)) % bits).astype(np.int64)
        at = at[(filter_bytes[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0]
    return at
