"""Trailing-window failure count and failure rate, anchored on the newest event.

After every batch whose events push the newest timestamp (over *all*
services) strictly higher, the result counts the target service's events
with ``ts >= newest - window`` that arrived in this or an earlier batch.

Exact, pair-free formulation: ``newest`` only grows, so an event stays in
the window from its arrival batch until the first emitting batch whose
newest exceeds ``ts + window``.  That end batch is an as-of lookup; the count
at each batch is then a running sum of +n at arrival and -n at expiry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.functions import (
    epoch_to_timestamp,
    error_4xx_5xx,
    failure_not_ok_message,
    safe_ratio,
    status_regex,
)
from loglens.plans.asof import min_after
from loglens.plans.materialize import materialize
from loglens.plans.scan import prefix_scan
from loglens.schema import DEFAULT_TIMESTAMP, SLIDING_WINDOW_SECONDS, TARGET_SERVICE

BATCH_BLOCK = 1024
# batches are blocked twice: the top window sees #batches / 1024**2 rows
BATCH_LEVELS = 2
# As-of blocks: one second of event time (so one block holds at most the
# distinct failure timestamps of one second, whatever the window), blocked
# again by 1024 s so the top window sees span/1024 s rows.
TIME_BLOCK_SECONDS = 1.0
TIME_LEVELS = 2


def batch_times(per: DataFrame, batch: str = "batch_id") -> DataFrame:
    """``(batch, newest, emits)`` from rows (batch, _bmax): the newest time up to the
    batch, and whether the batch raised it."""
    per_batch = per.groupBy(batch).agg(F.max("_bmax").alias("_bmax"))
    scanned = prefix_scan(per_batch, batch, [("_prev", "max", "_bmax")],
                          block_width=BATCH_BLOCK, levels=BATCH_LEVELS, exclusive=True)
    before = F.coalesce(F.col("_prev"), F.lit(DEFAULT_TIMESTAMP))
    return scanned.select(batch, F.greatest("_bmax", before).alias("newest"),
                          (F.col("_bmax") > before).alias("emits"))


def trailing_window_counts(df: DataFrame, weights: dict[str, Column], *,
                           window_seconds: float = SLIDING_WINDOW_SECONDS,
                           batch: str = "batch_id") -> DataFrame:
    """Per emitting batch: ``newest`` and, per weight column, the sum of the
    weights of events with ``ts >= newest - window`` arrived so far.

    ``weights`` are 0/1 (or counts) per event.  The events are read once, into
    one row per (batch, time of weighted events) that also carries the batch's
    newest time.  An event older than the window at its own arrival is dropped:
    ``newest`` only grows, so it can never be counted.  (A missing time
    counts as 0; those events would otherwise all share one as-of block.)
    """
    names = list(weights)
    ts = F.coalesce(F.col("timestamp"), F.lit(DEFAULT_TIMESTAMP))
    weighted = df.select(F.col(batch).alias("_arr"), ts.alias("_t"),
                         *[w.cast("bigint").alias(n) for n, w in weights.items()])
    any_w = None
    for n in names:
        c = F.col(n) != 0
        any_w = c if any_w is None else (any_w | c)
    # read by three branches, so written once
    per = materialize(
        weighted.groupBy("_arr", F.when(any_w, F.col("_t")).alias("_ts"))
        .agg(F.max("_t").alias("_bmax"), *[F.sum(n).alias(n) for n in names]), "window-events")
    times = materialize(batch_times(per, "_arr"), "batch-times")
    emits = times.where("emits").select(F.col("_arr").alias(batch), "newest")
    alive = F.col("_ts") >= F.col("newest") - F.lit(float(window_seconds))
    events = (per.where(F.col("_ts").isNotNull()).join(times.select("_arr", "newest"), "_arr").where(alive)
              .select("_arr", "_ts", *names, (F.col("_ts") + F.lit(float(window_seconds))).alias("_q")))
    # first emitting batch whose newest > ts + window
    ends = min_after(events, "_q", emits, "newest", batch, "_exp",
                     block_width=TIME_BLOCK_SECONDS, levels=TIME_LEVELS)
    # +w at arrival, -w at expiry (one pass over ``ends``)
    arrive = F.struct(F.col("_arr").alias("b"), *[F.col(n).alias(n) for n in names])
    expire = F.struct(F.greatest("_arr", "_exp").alias("b"), *[(-F.col(n)).alias(n) for n in names])
    moves = ends.select(F.explode(F.array(
        arrive, F.when(F.col("_exp").isNotNull(), expire))).alias("_m")).where(F.col("_m").isNotNull())
    moves = moves.select(F.col("_m.b").alias(batch), *[F.col(f"_m.{n}").alias(n) for n in names])
    zeros = emits.select(batch, *[F.lit(0).cast("bigint").alias(n) for n in names])
    deltas = (moves.unionByName(zeros)
              .groupBy(batch).agg(*[F.sum(n).alias(f"_d_{n}") for n in names]))
    active = prefix_scan(deltas, batch, [(n, "sum", f"_d_{n}") for n in names],
                         block_width=BATCH_BLOCK, levels=BATCH_LEVELS)
    return emits.join(active.select(batch, *names), on=batch, how="inner")


def _result(counts: DataFrame, value: Column, window_seconds: float, batch: str) -> DataFrame:
    return counts.select(
        batch,
        value.alias("value"),
        epoch_to_timestamp("newest").alias("newest_considered"),
        epoch_to_timestamp(F.col("newest") - F.lit(float(window_seconds))).alias("oldest_considered"),
    )


def sliding_failures(df: DataFrame, *, window_seconds: float = SLIDING_WINDOW_SECONDS,
                     service: str = TARGET_SERVICE, batch: str = "batch_id") -> DataFrame:
    """Count of the service's failures (message lacks ``HTTP Status Code: 200``)
    in the trailing window, after every batch that advances the newest time."""
    mine = (F.col("service") == F.lit(service)) & failure_not_ok_message("message")
    counts = trailing_window_counts(df, {"_fail": mine}, window_seconds=window_seconds, batch=batch)
    return _result(counts, F.col("_fail").cast("double"), window_seconds, batch)


def sliding_failure_rate(df: DataFrame, *, window_seconds: float = SLIDING_WINDOW_SECONDS,
                         service: str = TARGET_SERVICE, batch: str = "batch_id") -> DataFrame:
    """Documented form: 4xx/5xx share of the service's requests in the window."""
    mine = F.col("service") == F.lit(service)
    err = mine & F.coalesce(error_4xx_5xx(status_regex("message")), F.lit(False))
    counts = trailing_window_counts(df, {"_err": err, "_all": mine},
                                    window_seconds=window_seconds, batch=batch)
    return _result(counts, safe_ratio("_err", "_all"), window_seconds, batch)
