"""Uniform fixed-size sample of the stream and its most common status code.

Bottom-k sampling: every event gets a pseudo-random key ``md5(id:seed)`` and
the sample is the ``k`` smallest keys.  Each event is kept with probability
``k/n`` (the uniform reservoir), the sample is mergeable across partitions
(``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task
keeps ``k`` rows) and it is identical in any engine that has md5.
Identity comes from the event id (or file and position), never from the
content: identical events are common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglens.functions import epoch_to_timestamp, status_last_segment
from loglens.plans.materialize import materialize
from loglens.plans.scan import prefix_scan
from loglens.plans.topk import bottom_k, levels_for, prefix_bottom_k
from loglens.schema import GENERATOR_SEED, RESERVOIR_SIZE


def sample_key(id_col: Column | str, seed: int = GENERATOR_SEED) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))


def reservoir_sample(df: DataFrame, k: int = RESERVOIR_SIZE, seed: int = GENERATOR_SEED,
                     id_col: str = "event_id") -> DataFrame:
    """The ``k``-event uniform sample (``code`` = text after the last ``': '``).

    Only the key is computed per event; the code is read from the ``k``
    sampled messages after the top-k.
    """
    keyed = df.select(id_col, "batch_id", "service", "message",
                      sample_key(id_col, seed).alias("sample_key"))
    top = keyed.orderBy("sample_key", id_col).limit(k)
    return top.select(id_col, "batch_id", "service", status_last_segment("message").alias("code"),
                      "sample_key")


def sample_mode(sample: DataFrame, span_source: DataFrame) -> DataFrame:
    """Most common code of a sample (ties: smallest code) with the event-time
    span of everything seen; one row, none while the sample is empty."""
    mode = (sample.groupBy("code").agg(F.count(F.lit(1)).alias("sample_count"))
            .orderBy(F.desc("sample_count"), F.asc_nulls_last("code")).limit(1))
    span = span_source.agg(F.max("timestamp").alias("_new"), F.min("timestamp").alias("_old"))
    # combine the two one-row results by aggregation (no join needed)
    u = mode.select("code", "sample_count", F.lit(None).cast("double").alias("_new"),
                    F.lit(None).cast("double").alias("_old")).unionByName(
        span.select(F.lit(None).cast("string").alias("code"),
                    F.lit(None).cast("bigint").alias("sample_count"), "_new", "_old"))
    res = u.agg(F.max("code").alias("code"), F.max("sample_count").alias("sample_count"),
                F.max("_new").alias("_new"), F.min("_old").alias("_old"))
    return res.where(F.col("sample_count").isNotNull()).select(
        F.col("code").try_cast("double").alias("value"),
        "code",
        "sample_count",
        epoch_to_timestamp("_new").alias("newest_considered"),
        epoch_to_timestamp("_old").alias("oldest_considered"),
    )


def reservoir_mode(df: DataFrame, k: int = RESERVOIR_SIZE, seed: int = GENERATOR_SEED,
                   id_col: str = "event_id") -> DataFrame:
    return sample_mode(reservoir_sample(df, k, seed, id_col), df)


def batch_candidates(df: DataFrame, k: int = RESERVOIR_SIZE, seed: int = GENERATOR_SEED,
                     id_col: str = "event_id", batch: str = "batch_id") -> DataFrame:
    """``(batch, sample_key, event_id, code)``: the bottom ``k`` events of each batch.

    The rank filter becomes a ``WindowGroupLimit`` that Spark also applies
    before the shuffle, so each task ships at most ``k`` rows per batch.
    """
    keyed = df.select(batch, F.col(id_col).alias("event_id"), "message", sample_key(id_col, seed).alias("sample_key"))
    # the code is parsed for the k candidates of a batch only
    return bottom_k(keyed, batch, ["sample_key", "event_id"], k).select(
        batch, "sample_key", "event_id", status_last_segment("message").alias("code"))


def reservoir_sample_by_batch(df: DataFrame, k: int = RESERVOIR_SIZE,
                              seed: int = GENERATOR_SEED, id_col: str = "event_id",
                              batch: str = "batch_id", block_width: int = 32,
                              numbers: DataFrame | None = None) -> DataFrame:
    """The sample as it stands after every batch: ``k`` rows per batch, for any ``k``.

    1. candidates: the bottom ``k`` of each batch (a ranked window whose
       group limit Spark applies map-side before the shuffle, so a batch
       holding most of the rows still ships ``k`` rows per task);
    2. merged along the batch order by the blocked prefix merge of
       :mod:`loglens.plans.topk`, row by row (its depth
       is chosen from the batch-id range, one counter row to the driver).

    With ``numbers`` (``file_path``, ``batch_id``) a batch is a file, numbered
    after its candidates are drawn.
    """
    per_batch = batch_candidates(df, k, seed, id_col, batch if numbers is None else "file_path")
    if numbers is not None:
        per_batch = per_batch.join(numbers.select("file_path", F.col("batch_id").alias(batch)), "file_path").drop("file_path")
    # at most k candidates per batch, read by every level of the merge: written once
    per_batch = materialize(per_batch, "sample-candidates")
    bounds = per_batch.agg(F.min(batch), F.max(batch)).first()
    span = 0 if bounds[0] is None else int(bounds[1]) - int(bounds[0]) + 1
    merged = prefix_bottom_k(per_batch, batch, ["sample_key", "event_id"], k, width=block_width,
                             levels=levels_for(span, block_width))
    return merged.select(batch, "event_id", "code", "sample_key")


BLOCK_SAMPLES = 8  # candidates of a block of batches, in samples


def sample_mode_by_batch(candidates: DataFrame, k: int, batch: str) -> DataFrame:
    """``batch, code, sample_count`` after every batch, from :func:`batch_candidates`, without the ``k`` rows of each batch.

    Batches are cut into blocks of about ``BLOCK_SAMPLES`` x ``k`` candidates.  What a block inherits is the
    bottom ``k`` of the blocks before (:mod:`loglens.plans.topk`); one task takes a block's candidates
    that can still enter in batch order and counts the codes of the sample as events enter and leave."""
    key = ["sample_key", "event_id"]
    cand = materialize(candidates, "sample-candidates")
    sizes = prefix_scan(cand.groupBy(batch).agg(F.count("*").alias("_n")), batch, [("_upto", "sum", "_n")], block_width=1024, levels=2)
    blocks = materialize(sizes.select(batch, F.floor((F.col("_upto") - F.col("_n")) / (BLOCK_SAMPLES * k)).cast("bigint").alias("_block")),
                         "sample-blocks")
    own = materialize(cand.join(blocks, batch), "sample-by-block")
    top = blocks.agg(F.max("_block")).first()[0] or 0
    summary = bottom_k(own.drop(batch), "_block", key, k)
    inherited = materialize(prefix_bottom_k(summary, "_block", key, k, places=blocks.select("_block").distinct(), width=32,
                                            levels=levels_for(top + 1, 32), exclusive=True), "sample-inherited")
    last = F.struct(*key)
    full = inherited.groupBy("_block").agg(F.count("*").alias("_n"), F.max(last).alias("_last")).where(F.col("_n") == k).drop("_n")
    own = own.join(full, "_block", "left").where(F.col("_last").isNull() | (last < F.col("_last"))).drop("_last")
    no_batch, typ = F.lit(0).cast(own.schema[batch].dataType), own.schema[batch].dataType.simpleString()
    rows = (inherited.select("_block", *key, "code", no_batch.alias("batch"), F.lit(0).alias("kind"))
            .unionByName(own.select("_block", *key, "code", F.col(batch).alias("batch"), F.lit(1).alias("kind"))))
    place = F.row_number().over(Window.partitionBy("_block").orderBy(*key, "kind", "batch"))
    placed = rows.select("_block", "batch", "kind", "code", place.alias("place")).unionByName(blocks.select(
        "_block", F.col(batch).alias("batch"), F.lit(2).alias("kind"), F.lit(None).cast("string").alias("code"), F.lit(0).alias("place")))

    def modes_in_block(rows):
        """The mode after every batch of a block: ``rows`` hold what the block inherits (kind 0), its own candidates (1) and one
        row per batch (2), with their ``place`` in the block's key order."""
        import heapq

        import pandas as pd

        codes = [None if pd.isna(c) else c for c in rows["code"]]
        order = {c: i for i, c in enumerate(sorted(set(codes), key=lambda c: (c is None, c or "")))}
        named = list(order)
        code = {}   # place of a sampled event -> its code's number
        sample = []  # largest place first
        counts = [0] * len(order)
        best = []   # (-count, code) as of each change; outdated ones go when they come to the top

        def change(c, by):
            counts[c] += by
            heapq.heappush(best, (-counts[c], c))

        out = []
        steps = sorted(zip(rows["kind"] > 0, rows["batch"], rows["kind"], rows["place"], codes, strict=True), key=lambda x: x[:4])
        for _, batch, kind, place, c in steps:
            if kind < 2:
                if len(sample) == k and place > -sample[0]:
                    continue
                code[place] = order[c]
                change(order[c], 1)
                gone = heapq.heappushpop(sample, -place) if len(sample) == k else heapq.heappush(sample, -place)
                if gone is not None:
                    change(code.pop(-gone), -1)
            else:
                while -best[0][0] != counts[best[0][1]]:
                    heapq.heappop(best)
                out.append((batch, named[best[0][1]], -best[0][0]))
        return pd.DataFrame(out, columns=["batch", "code", "sample_count"])

    # a function of its own, sent to the workers by value: they need not have this package
    modes = placed.where(F.col("batch").isNotNull()).groupBy("_block").applyInPandas(
        modes_in_block, f"batch {typ}, code string, sample_count bigint")
    return modes.withColumnRenamed("batch", batch)


def reservoir_mode_by_batch(df: DataFrame, k: int = RESERVOIR_SIZE, seed: int = GENERATOR_SEED,
                            id_col: str = "event_id", batch: str = "batch_id") -> DataFrame:
    """The result after every batch: mode of the sample at that point (ties:
    smallest code) and the running span of all timestamps seen."""
    mode = sample_mode_by_batch(batch_candidates(df, k, seed, id_col, batch), k, batch)
    per_batch = df.groupBy(batch).agg(F.max("timestamp").alias("_bmax"), F.min("timestamp").alias("_bmin"))
    span = prefix_scan(per_batch, batch, [("_new", "max", "_bmax"), ("_old", "min", "_bmin")],
                       block_width=1024, levels=2)
    return mode.join(span, batch).select(
        batch,
        F.col("code").try_cast("double").alias("value"),
        "code",
        "sample_count",
        epoch_to_timestamp("_new").alias("newest_considered"),
        epoch_to_timestamp("_old").alias("oldest_considered"),
    )
