"""Bloom-filter forwarding of messages of interest.

Build: the ``k`` bit indices of every pattern, deduplicated, folded into
64-bit words: a table ``(word, bits)`` with ``word = i // 64`` and bit
``i % 64`` of ``bits`` set (LSB first), only non-zero words kept.  The
filter has at most ``ceil(m / 64)`` rows, so its size is known before it is
built: it is broadcast when that bound fits under the session's
broadcast-join threshold and joined by shuffle otherwise (also when
broadcasting is disabled).

Test, by the size of the filter (``ceil(m / 64)`` words, known beforehand):

* up to ``CONSTANT_WORDS`` words it enters the plan as one array constant, and the test is a projection;
* up to the broadcast threshold, an equi-join on the word for each index, one broadcast reused ``k`` times;
* beyond, by the words: each distinct message asks for its ``k`` words in one join, its bits are
  AND-ed back by message, and the events meet the answers in their only exchange.

In the first two a row stops hashing at its first unset bit.  ``exact_forward`` is the twin without
false positives.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.functions import bloom_index, bloom_indices, epoch_to_timestamp
from loglens.schema import BLOOM_BITS, BLOOM_HASHES

WORD_BITS = 64
CONSTANT_WORDS = 65_536  # half a megabyte in the plan
DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def bloom_bits(patterns: DataFrame, text_col: str = "pattern", m_bits: int = BLOOM_BITS,
               k_hashes: int = BLOOM_HASHES) -> DataFrame:
    """Distinct set bit positions of the filter."""
    idx = F.explode(F.array(*bloom_indices(text_col, k_hashes, m_bits))).alias("bit")
    return patterns.where(F.col(text_col).isNotNull()).select(idx).distinct()


def bloom_build(patterns: DataFrame, text_col: str = "pattern", m_bits: int = BLOOM_BITS,
                k_hashes: int = BLOOM_HASHES) -> DataFrame:
    """The filter as ``(word, bits)`` rows; at most ``ceil(m / 64)`` rows."""
    bits = bloom_bits(patterns, text_col, m_bits, k_hashes)
    mask = F.expr(f"shiftleft(cast(1 as bigint), cast(pmod(bit, {WORD_BITS}) as int))")
    return bits.groupBy(F.floor(F.col("bit") / WORD_BITS).cast("bigint").alias("word")).agg(
        F.bit_or(mask).alias("bits"))


def broadcast_limit(spark) -> int:
    """The session's broadcast-join threshold in bytes (-1: disabled)."""
    try:
        return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    except Exception:  # noqa: BLE001 - non-classic sessions: the documented default
        return DEFAULT_BROADCAST_BYTES


def filter_bytes(m_bits: int) -> int:
    """Upper bound of the built filter: ceil(m/64) rows of two longs plus a
    row header (48 bytes a row)."""
    return 48 * (-(-m_bits // WORD_BITS))


def _bit(bits: str, index: str) -> Column:
    """Bit ``index % 64`` of a filter word (0 when the word is absent)."""
    return F.coalesce(
        F.expr(f"shiftright({bits}, cast(pmod({index}, {WORD_BITS}) as int)) & 1"), F.lit(0))


def _probe(df: DataFrame, side: DataFrame, text: str, out: str, m_bits: int,
           k_hashes: int) -> DataFrame:
    """Add ``out`` to ``df`` (which holds the text column ``text``).

    For each index: an equi-join on the word number (the same filter
    DataFrame under k aliases: one broadcast, reused k times).  Index i is
    hashed only where bits 0 to i-1 are set, so most non-members cost one
    SHA-256; rows already decided get a negative word that no filter holds,
    spread by hash in case the join shuffles.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    decided = -1 - F.pmod(F.xxhash64(F.col(text)), F.lit(1 << 40))
    cur = df.withColumn("_bl_on", F.lit(True))
    for i in range(k_hashes):
        f = f"_bl_f{i}"
        cur = cur.withColumn("_bl_i", F.when(F.col("_bl_on"), bloom_index(text, i, m_bits)).otherwise(decided))
        cur = cur.join(side.alias(f), F.floor(F.col("_bl_i") / WORD_BITS) == F.col(f"{f}.word"), "left")
        cur = cur.select(*cols, (F.col("_bl_on") & (_bit(f"`{f}`.bits", "_bl_i") == 1)).alias("_bl_on"))
    return cur.select(*cols, F.col("_bl_on").alias(out))


def bloom_test(words: DataFrame, m_bits: int = BLOOM_BITS, k_hashes: int = BLOOM_HASHES) -> Callable[[Column], Column] | None:
    """The test as a column function over an array constant of the filter's words, which is read here, once;
    None if the filter may have more than ``CONSTANT_WORDS``."""
    n = -(-m_bits // WORD_BITS)
    if n > CONSTANT_WORDS:
        return None
    held = [0] * n
    for word, bits in words.select("word", "bits").collect():
        held[word] = bits
    array = F.from_json(F.lit(json.dumps(held, separators=(",", ":"))), "array<bigint>")  # folded to a constant

    def test(text: Column) -> Column:
        out = F.lit(True)
        for i in range(k_hashes):
            at = bloom_index(text, i, m_bits)
            word = F.get(array, F.floor(at / WORD_BITS).cast("int"))
            out = out & (word.bitwiseAND(_mask(at)) != 0)
        return F.coalesce(out, F.lit(False))  # a null is no member

    return test


def _mask(index: Column) -> Column:
    """The bit of an index in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(index, F.lit(WORD_BITS)).cast("int"))


def _probe_by_word(df: DataFrame, words: DataFrame, text: str, out: str, m_bits: int, k_hashes: int) -> DataFrame:
    """Add ``out`` to ``df`` with one exchange of its rows, however many hashes: the distinct messages (as
    digests) ask for their words in one join."""
    digest = F.md5(F.col(text))
    index = [bloom_index(text, i, m_bits) for i in range(k_hashes)]
    ask = F.array(*[F.struct(F.floor(i / WORD_BITS).cast("bigint").alias("word"), _mask(i).alias("mask")) for i in index])
    asked = (df.select(digest.alias("_bl_d"), ask.alias("_bl_a")).groupBy("_bl_d").agg(F.first("_bl_a").alias("_bl_a"))
             .select("_bl_d", F.inline("_bl_a")))
    bit = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) != 0, F.lit(False))
    answers = asked.join(words, "word", "left").groupBy("_bl_d").agg(F.bool_and(bit).alias(out))
    return df.withColumn("_bl_d", digest).join(answers, "_bl_d", "left").drop("_bl_d").withColumn(out, F.coalesce(out, F.lit(False)))


def bloom_contains(df: DataFrame, words: DataFrame, text: Column | str, out: str = "hit",
                   m_bits: int = BLOOM_BITS, k_hashes: int = BLOOM_HASHES,
                   test: Callable[[Column], Column] | None = None) -> DataFrame:
    """Add boolean ``out``: all ``k`` bits of ``text`` are set (a probable member).

    With a filter of a constant's or a broadcast's size, rows are tested in place: one read of the input, no
    shuffle; with a larger one they are exchanged once.  ``test``: of :func:`bloom_test`, where
    the same filter is asked many times."""
    t = F.col(text) if isinstance(text, str) else text
    test = test or bloom_test(words, m_bits, k_hashes)
    if test is not None:
        return df.withColumn(out, test(t))
    df = df.withColumn("_bl_t", t)
    if 0 < filter_bytes(m_bits) <= broadcast_limit(words.sparkSession):
        return _probe(df, F.broadcast(words), "_bl_t", out, m_bits, k_hashes).drop("_bl_t")
    return _probe_by_word(df, words, "_bl_t", out, m_bits, k_hashes).drop("_bl_t")


def exact_forward(df: DataFrame, patterns: DataFrame, message: str = "message", text_col: str = "pattern") -> DataFrame:
    """Events whose message is in the pattern list: what :func:`bloom_forward` gives without its false positives."""
    known = patterns.select(F.col(text_col).alias("_pattern")).where(F.col("_pattern").isNotNull()).distinct()
    return df.join(known, F.coalesce(F.col(message), F.lit("")) == F.col("_pattern"), "left_semi")


def bloom_forward(df: DataFrame, words: DataFrame, message: str = "message",
                  m_bits: int = BLOOM_BITS, k_hashes: int = BLOOM_HASHES) -> DataFrame:
    """Events whose message is (probably) in the pattern list; no false negatives."""
    msg = F.coalesce(F.col(message), F.lit(""))
    return bloom_contains(df, words, msg, "_fwd", m_bits, k_hashes).where("_fwd").drop("_fwd")


def bloom_hit_ratio(df: DataFrame, words: DataFrame, batch: str = "batch_id",
                    m_bits: int = BLOOM_BITS, k_hashes: int = BLOOM_HASHES,
                    test: Callable[[Column], Column] | None = None) -> DataFrame:
    """Per batch: share of all its events that the filter forwards, with the
    batch's own time span; batches without any timestamp emit nothing.

    Events are first summed by (batch, message), map-side too: a message on most
    rows is one row a task, each distinct message of a batch is probed once,
    and nothing is joined back.
    """
    msg = F.coalesce(F.col("message"), F.lit(""))
    per = (df.groupBy(batch, msg.alias("_bl_m"))
           .agg(F.count(F.lit(1)).alias("_n"), F.count("timestamp").alias("_nts"),
                F.max("timestamp").alias("_new"), F.min("timestamp").alias("_old")))
    tested = bloom_contains(per, words, "_bl_m", "_hit", m_bits, k_hashes, test)
    return (tested.groupBy(batch)
            .agg(F.sum(F.when(F.col("_hit"), F.col("_n")).otherwise(0)).alias("hits"),
                 F.sum("_n").alias("events"), F.sum("_nts").alias("_nts"),
                 F.max("_new").alias("_new"), F.min("_old").alias("_old"))
            .where(F.col("_nts") > 0)
            .select(batch, "hits", "events",
                    (F.col("hits") / F.col("events")).cast("double").alias("value"),
                    epoch_to_timestamp("_new").alias("newest_considered"),
                    epoch_to_timestamp("_old").alias("oldest_considered")))
