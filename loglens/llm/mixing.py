"""Mixing sources to target weights by Sainte-Lague apportionment of token blocks.

Targets: sources share all words by weight; a target stops at ``max_epochs``
times its source's words and the excess is shared again by weight.  Each source
is dealt into shards of bounded words, each shard is cut into equal blocks of
about ``block_words`` words, and the blocks of the whole mix are allocated to
the shards by the highest quotients v / (2 j + 1), where v is the number of
blocks a shard's target asks for.  In a shard a quota of q over n blocks takes
every block q div n times, and q mod n blocks, chosen by a seeded order, once
more.  A document gets the words of its blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import WORD_REGEX, read, stage, with_rank

BLOCK_WORDS, SHARD_WORDS, SHARD_DOCS = 16, 1_000_000, 100_000


def water_level(sources: DataFrame) -> float:
    """The level x at which targets min(cap, x * weight) sum to all words.

    ``sources`` has ``weight, words, cap``.  Each pass shares what the capped
    sources leave among the others; only sums come to the driver.
    """
    total, weights = sources.agg(F.sum("words"), F.sum("weight")).first()
    if not total:
        return 0.0
    level, capped = total / weights, -1
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        n, cap, rest = sources.agg(F.count(F.when(full, 1)), F.sum(F.when(full, F.col("cap"))),
                                   F.sum(F.when(~full, F.col("weight")))).first()
        if n == capped or not rest:
            return level
        level, capped = (total - (cap or 0)) / rest, n


def sainte_lague(cells: DataFrame, seats: int) -> DataFrame:
    """``cells`` (``key``, ``votes``, ``most``) plus ``quota``: ``seats`` seats to the
    highest quotients votes / (2 j + 1), at most ``most`` a cell, ties to the smaller key.

    Votes sum to about ``seats``, so the divisor is near 1: a cell's seats far
    below its votes are sure, and only the few around them compete.
    """
    open_ = F.col("votes") < F.col("most")
    n, open_votes = cells.agg(F.count(F.when(open_, 1)), F.sum(F.when(open_, F.col("votes")))).first()
    reach = (F.lit(2) + F.ceil(F.lit((n / 2 + 1) / max(open_votes or 1.0, 1e-9)) * F.col("votes"))).cast("bigint")
    ranged = (cells.withColumn("sure", F.greatest(F.lit(0), F.least(F.floor("votes") - reach, F.col("most"))).cast("bigint"))
              .withColumn("end", F.least(F.floor("votes") + reach, F.col("most")).cast("bigint")))
    sure = ranged.agg(F.sum("sure")).first()[0] or 0
    seatsdf = (ranged.where(F.col("end") > F.col("sure"))
               .select("key", "votes", F.explode(F.sequence(F.col("sure"), F.col("end") - 1)).alias("j"))
               .select("key", "j", (F.col("votes") / (2 * F.col("j") + 1)).alias("quotient")))
    won = (with_rank(seatsdf, [F.desc("quotient"), F.asc("key"), F.asc("j")], "seats", "place")
           .where(F.col("place") < seats - sure).groupBy("key").agg(F.count("*").alias("won")))
    return (ranged.join(won, "key", "left")
            .withColumn("quota", F.col("sure") + F.coalesce("won", F.lit(0))).drop("sure", "end", "won"))


def _take(seed: int, block_words: int):
    """Of one shard: words taken of each document."""

    def take(shard: pa.Table) -> pa.Table:
        words = shard["size"].to_numpy().astype(np.int64)
        if not len(words):
            return shard.drop_columns(["key", "shard", "quota"]).append_column("taken", pa.array(words))
        ids = [f"{seed}:{i}".encode() for i in shard["id"].to_pylist()]
        order = np.lexsort((words, np.array([xxhash.xxh3_64_intdigest(i) for i in ids], np.uint64)))
        ends = np.cumsum(words[order])
        total, quota = int(ends[-1]), int(shard["quota"][0].as_py())
        n = -(-total // block_words)
        edges = np.arange(n + 1, dtype=np.int64) * total // n
        rng = np.random.default_rng([seed & 0xFFFFFFFF, int(shard["key"][0].as_py()) & 0x7FFFFFFFFFFFFFFF])
        times = np.full(n + 1, quota // n, np.int64)
        times[rng.permutation(n)[: quota % n]] += 1
        times[n] = 0
        until = np.concatenate(([0], np.cumsum(times[:n] * np.diff(edges))))

        def before(x: np.ndarray) -> np.ndarray:
            at = np.searchsorted(edges, x, "right") - 1
            return until[at] + times[at] * (x - edges[at])

        taken = np.empty(len(words), np.int64)
        taken[order] = before(ends) - before(ends - words[order])
        return shard.drop_columns(["key", "shard", "quota"]).append_column("taken", pa.array(taken))

    return take


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source", max_epochs: int = 3, seed: int = 7,
                block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
                shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Per row of ``docs``: ``<id_col>, size, source_size, target, taken``.

    ``weights`` repeat over the sources in code point order, null last.
    ``taken`` counts the document's words in the mix, repeats included; it
    never exceeds ``max_epochs * size``.  Shards hold ``shard_words`` words and
    ``shard_docs`` documents on average, whatever the size of their source.
    Defined cases: a null or empty text has size 0 and nothing taken; a source
    of empty texts has target 0; repeated rows take part row by row; a null id
    is an id like any other; an empty table gives no rows.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_REGEX)), F.lit(0)).cast("bigint")
    rows = stage(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(source_col).cast("string").alias("source"),
                             size.alias("size")), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    ranked = with_rank(sources, [F.asc_nulls_last("source")], "sources", "nr")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("nr", F.lit(len(weights))).cast("int"))
    ranked = stage(ranked.withColumn("weight", weight).withColumn("cap", F.col("words") * max_epochs), "weights")
    level = water_level(ranked)
    parts = F.greatest(F.ceil(F.col("words") / shard_words), F.ceil(F.col("docs") / shard_docs), F.lit(1))
    targets = ranked.select("source", "nr", "words", parts.cast("bigint").alias("parts"),
                            F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"))
    # few rows a source: the sizes' side is split by Spark where a source is hot
    joined = (rows.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
              .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "id", "size"), "parts"))
              .select("id", "size", F.col("words").alias("source_size"), "target", "nr", "shard"))
    dealt = stage(joined, "dealt")
    blocks = F.ceil(F.col("words") / block_words).cast("bigint")
    cells = (dealt.groupBy("nr", "shard").agg(F.sum("size").alias("words"), F.first("target").alias("target"),
                                              F.first("source_size").alias("of"))
             .where("words > 0")
             .withColumn("blocks", blocks).withColumn("key", F.struct("nr", "shard"))
             .withColumn("most", F.col("blocks") * max_epochs)
             .withColumn("votes", F.least(F.col("blocks") * F.col("target") / F.col("of"), F.col("most").cast("double")))
             .select("key", "votes", "most"))
    cells = stage(cells, "cells")
    seats = round(cells.agg(F.sum("votes")).first()[0] or 0)
    quotas = sainte_lague(cells, seats).select(F.col("key.nr").alias("nr"), F.col("key.shard").alias("shard"), "quota")
    out = "id bigint, size bigint, source_size bigint, target double, taken bigint"
    some = (dealt.where("size > 0").join(quotas, ["nr", "shard"])
            .withColumn("key", F.xxhash64("nr", "shard"))
            .groupBy("key", "shard")
            .applyInArrow(lambda t: _take(seed, block_words)(t.drop_columns(["nr"])).select(
                ["id", "size", "source_size", "target", "taken"]), out))
    none = dealt.where("size = 0").select("id", "size", "source_size", "target", F.lit(0).cast("bigint").alias("taken"))
    return some.unionByName(none).withColumnRenamed("id", id_col)


def query(spark, sf_dir) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"))
