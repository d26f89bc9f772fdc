"""Bloom-filter bit indices.

Index ``i`` of string ``s`` in an ``m``-bit filter: the first four bytes of
SHA-256 over (``i`` as two big-endian bytes, then ``s`` as UTF-8), read as a
big-endian unsigned 32-bit integer, modulo ``m``.  Pure JVM expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglens.functions.status import _col


def bloom_index(text: Column | str, i: int, m_bits: int) -> Column:
    if not 0 <= i < 65536:
        raise ValueError("hash number must fit in two bytes")
    prefix = F.lit(bytearray(i.to_bytes(2, "big")))
    digest = F.sha2(F.concat(prefix, F.encode(_col(text), "UTF-8")), 256)
    word = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return word % F.lit(int(m_bits))


def bloom_indices(text: Column | str, k_hashes: int, m_bits: int) -> list[Column]:
    """The ``k`` indices, unrolled as separate columns (stays in codegen)."""
    return [bloom_index(text, i, m_bits) for i in range(k_hashes)]
