"""Running (cumulative) success rate and running event-time span.

Arrival order is the numeric ``batch_id``.  Events are first reduced to one
row per batch (or per batch and service); the cumulative step runs on that
small table through the blocked prefix scan, never over raw events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.functions import epoch_to_timestamp, safe_ratio, status_strict, success_2xx
from loglens.plans.materialize import materialize
from loglens.plans.scan import prefix_scan
from loglens.schema import DEFAULT_SERVICE, DEFAULT_TIMESTAMP, TARGET_SERVICE

BATCH_BLOCK = 1024
# batches are blocked twice: the top window sees #batches / 1024**2 rows
BATCH_LEVELS = 2


def _ts() -> Column:
    return F.coalesce(F.col("timestamp"), F.lit(DEFAULT_TIMESTAMP))


def _span_aggs() -> list[Column]:
    """Per-batch span inputs: only ts > 0 may raise the newest; ts = 0 never
    counts as the oldest."""
    ts = _ts()
    return [F.max(F.when(ts > 0, ts)).alias("_bnew"),
            F.min(F.when(ts != 0, ts)).alias("_bold")]


def _span_cols(batch: str) -> list[Column]:
    return [F.col(batch),
            epoch_to_timestamp("_newest").alias("newest_considered"),
            epoch_to_timestamp("_oldest").alias("oldest_considered")]


def running_time_span(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Cumulative newest/oldest event time over all services, per batch;
    batches before both exist emit nothing."""
    per_batch = df.groupBy(batch).agg(*_span_aggs())
    scanned = prefix_scan(per_batch, batch, [("_newest", "max", "_bnew"), ("_oldest", "min", "_bold")],
                          block_width=BATCH_BLOCK, levels=BATCH_LEVELS)
    return scanned.where(F.col("_newest").isNotNull() & F.col("_oldest").isNotNull()).select(
        *_span_cols(batch))


def _coded(df: DataFrame) -> DataFrame:
    code = status_strict("message")
    return df.select(
        "*",
        F.coalesce(F.col("service"), F.lit(DEFAULT_SERVICE)).alias("_svc"),
        code.alias("_code"),
        F.when(success_2xx(code), 1).otherwise(0).alias("_ok"),
    )


def running_success_rate(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Cumulative 2xx share of coded events per service, one row per
    (batch, service present in the batch), with the global running span.

    Uncoded events stay out of the rate but inside the span.  One pass over
    the events: the per-(batch, service) aggregate also carries the span
    inputs, and the per-batch span is rolled up from it.
    """
    coded = _coded(df)
    # small (batch x service) table read by two branches: written once
    per = materialize(coded.groupBy(batch, "_svc").agg(
        F.count("_code").alias("_n"),
        F.sum(F.when(F.col("_code").isNotNull(), F.col("_ok")).otherwise(0)).alias("_s"),
        *_span_aggs()), "running-per-batch")
    scanned = prefix_scan(per.drop("_bnew", "_bold"), batch,
                          [("total", "sum", "_n"), ("successes", "sum", "_s")],
                          partition_by=["_svc"], block_width=BATCH_BLOCK, levels=BATCH_LEVELS)
    per_batch = per.groupBy(batch).agg(F.max("_bnew").alias("_bnew"), F.min("_bold").alias("_bold"))
    span = prefix_scan(per_batch, batch, [("_newest", "max", "_bnew"), ("_oldest", "min", "_bold")],
                       block_width=BATCH_BLOCK, levels=BATCH_LEVELS)
    span = span.where(F.col("_newest").isNotNull() & F.col("_oldest").isNotNull()).select(
        *_span_cols(batch))
    return scanned.join(span, on=batch, how="inner").select(
        batch,
        F.col("_svc").alias("service"),
        F.col("successes").cast("bigint").alias("successes"),
        F.col("total").cast("bigint").alias("total"),
        safe_ratio("successes", "total").alias("value"),
        "newest_considered",
        "oldest_considered",
    )


def running_target_scan(df: DataFrame, service: str = TARGET_SERVICE, batch: str = "batch_id",
                        numbers: DataFrame | None = None) -> DataFrame:
    """Per batch the cumulative counts of one service and span of all (``_newest``, ``_oldest``).

    With ``numbers`` (``file_path``, ``batch_id``) a batch is a file: events are
    summed per file and only those sums meet the number, so a large file is
    never a join key of its events."""
    coded = _coded(df)
    mine = F.col("_svc") == F.lit(service)
    per = coded.groupBy("file_path" if numbers is not None else batch).agg(
        F.count(F.when(mine, F.col("_code"))).alias("_n"),
        F.sum(F.when(mine & F.col("_code").isNotNull(), F.col("_ok")).otherwise(0)).alias("_s"),
        *_span_aggs())
    if numbers is not None:
        per = per.join(numbers.select("file_path", F.col("batch_id").alias(batch)), "file_path")
    return prefix_scan(
        per, batch,
        [("total", "sum", "_n"), ("successes", "sum", "_s"),
         ("_newest", "max", "_bnew"), ("_oldest", "min", "_bold")],
        block_width=BATCH_BLOCK, levels=BATCH_LEVELS)


def running_target_rows(scanned: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Result rows of a scan; batches before a span exists emit nothing."""
    return scanned.where(F.col("_newest").isNotNull() & F.col("_oldest").isNotNull()).select(
        batch,
        F.col("successes").cast("bigint").alias("successes"),
        F.col("total").cast("bigint").alias("total"),
        safe_ratio("successes", "total").alias("value"),
        *_span_cols(batch)[1:],
    )


def running_success_rate_target(df: DataFrame, service: str = TARGET_SERVICE, batch: str = "batch_id",
                                numbers: DataFrame | None = None) -> DataFrame:
    """The single-value result: cumulative rate of one service after every
    batch (0.0 before it has coded events), with the running span.  ``numbers``: as in
    :func:`running_target_scan`."""
    return running_target_rows(running_target_scan(df, service, batch, numbers), batch)
