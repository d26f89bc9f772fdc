"""Pieces the training-data operators share: words, stable hashes, staging, ranks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.plans.materialize import materialize, tidied  # noqa: F401
from loglens.plans.rank import with_rank  # noqa: F401

#: ASCII white space, \x20 and \x09-\x0D; also what ``bytes.split()`` splits at.
WHITE = " \t\n\x0b\f\r"
#: A word, as a Java regular expression.
WORD_REGEX = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: cuts
    the lineage, so a lost executor re-reads files, and several readers don't
    compute it again."""
    return materialize(df, name, compression)


def discard(df: DataFrame) -> None:
    """Remove the files of a staged table; only once all that is built from it is staged."""
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent() if df.inputFiles() else None
    if folder is not None:
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def arrow_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Jobs run inside hand rows to Python workers in batches of about ``limit`` bytes, or one row
    (a session setting: kept if already set, else unset again).

    Spark's own bounds are 10,000 rows and 64 MB: a batch of whole texts is then held several times
    over beside the heap (vectors and a buffer, which grow by doubling, in the executor, the
    batch and what comes of it in the worker), in every task at once."""
    if spark.conf.get(BATCH_CONF, None) is not None:
        yield
        return
    spark.conf.set(BATCH_CONF, str(limit))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_CONF)


#: Rows of a few numbers (about 50 MB as a hash table) up to which a staged table is broadcast.
SMALL_ROWS = 1_000_000


def small_side(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A staged table of narrow rows, marked for broadcast if a count finds it small
    enough: the other side, of whole texts, then stays where it is.  A larger
    table is joined by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of ``key``, as one sorted table.

    A count first sets how far up the hashes the sample can reach, so tasks hand
    over about ``rows`` rows together, not ``rows`` each.
    """
    total = df.count()
    share = 1.0 if total <= rows else min(1.0, 1.1 * rows / total + 4 * rows ** 0.5 / total)
    low = F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30))
    rest = [c for c in df.columns if c != key]
    return (df.where(F.lit(share >= 1.0) | low)
            .orderBy(F.pmod(F.xxhash64(key), F.lit(1 << 30)), key, *rest).limit(rows))


def join_hot(big: DataFrame, small: DataFrame, keys: list[str], salt_from: Column,
             how: str = "inner", salts: int = 32) -> DataFrame:
    """``big`` joined to ``small`` (one row per key) where one key may hold a third of ``big``.

    Rows of ``big`` are salted; ``small`` is copied only to the salts that its
    key really has (at most ``salts`` rows a key), so no key is in one task.
    ``big`` is read twice: stage it first.
    """
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(salt_from), F.lit(salts)))
    spread = salted.select(*keys, "_salt").distinct().join(small, keys)
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")


_RNG = np.random.default_rng(20240229)
#: One random 64-bit value per byte, A-Z as a-z; and the odd base of the word polynomial.
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
BYTE_VALUES[65:91] = BYTE_VALUES[97:123]
BASE = int(_RNG.integers(2**61, 2**62)) * 2 + 1
IS_WHITE = np.zeros(256, bool)
IS_WHITE[[9, 10, 11, 12, 13, 32]] = True
CHUNK_BYTES = 500_000  # temporary arrays stay in the processor's cache


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_KEPT: dict[str, np.ndarray] = {}


def _powers_kept(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_KEPT.get("up", ())) < n:
        _KEPT["up"] = powers(n)
        _KEPT["down"] = powers(n, pow(BASE, -1, 2**64))
    return _KEPT["up"], _KEPT["down"]


def text_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A binary column in runs of rows of at most ``limit`` bytes (or one row):
    first row, row after the last, the run's bytes, offsets of its rows in them.
    A null is empty."""
    raw = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, raw[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_hashes(raw: np.ndarray, off: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Words of a run of rows: a 64-bit hash of each, blind to the case of A-Z,
    and offsets by row.  Words are runs of bytes not marked in ``apart`` (ASCII
    white space by default), none across rows."""
    n = len(raw)
    white = np.ones(n + 1, bool)
    white[:n] = IS_WHITE[raw] if apart is None else apart
    first = ~white[:n]
    first[1:] &= white[:n - 1]
    edges = off[1:-1]
    edges = edges[edges < n]
    first[edges] |= ~white[edges]
    start = np.flatnonzero(first)
    last = ~white[:n]
    last[:-1] &= white[1:n]
    inner = edges[edges > 0] - 1
    last[inner] |= ~white[inner]
    end = np.flatnonzero(last) + 1
    up, down = _powers_kept(1 << (n + 1).bit_length())
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[raw] * up[:n], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return mix(h + (end - start).astype(np.uint64)), np.searchsorted(start, off)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each run of ``k`` words (given as hashes), in order.

    A sequence of 1 to k-1 words is one shingle as a whole; none gives none.
    The length enters the hash: a short sequence never equals a longer run.
    """
    n = len(words)
    k = min(k, n)
    if not n:
        return np.empty(0, np.uint64)
    acc = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + words[j:n - k + 1 + j]
    return mix(acc)


def shingle_sets(raw: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The distinct ``k``-word shingles of each row, ascending."""
    h, at = word_hashes(raw, off)
    for i in range(len(at) - 1):
        yield np.unique(shingle_hashes(h[at[i]:at[i + 1]], k))
