"""Tumbling and hopping window success rate per service (batch form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.operators.parse import rate_inputs
from loglens.schema import WINDOW_DURATION


def window_success_stats(parsed: DataFrame, window_duration: str,
                         slide_duration: str | None) -> DataFrame:
    """``(window, service) -> total, successes, rate`` over :func:`rate_inputs`
    rows (complete rows counted, groups without any dropped afterwards).

    Shared by the batch and streaming forms.  count/sum are algebraic, so
    Spark pre-aggregates map-side and only (window, service) partials shuffle.
    """
    slide = slide_duration or window_duration
    ok = F.col("_ok")
    return (
        parsed.groupBy(F.window("event_time", window_duration, slide), "service")
        .agg(
            F.count(F.when(ok, 1)).alias("total"),
            F.sum(F.when(ok, F.col("is_success"))).cast("bigint").alias("successes"),
        )
        .where(F.col("service").isNotNull() & F.col("window").isNotNull() & (F.col("total") > 0))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "service",
            "total",
            "successes",
            (F.col("successes") / F.col("total")).cast("double").alias("success_rate"),
        )
    )


def windowed_success_rate(df: DataFrame, window_duration: str = WINDOW_DURATION,
                          slide_duration: str | None = None, *,
                          truncate_to_second: bool = True) -> DataFrame:
    """Success rate per (event-time window, service), sorted by window, service.

    Event time is truncated to the second by default (``from_unixtime``
    parity); it only matters for sub-second windows.
    """
    parsed = rate_inputs(df, truncate_to_second=truncate_to_second)
    return window_success_stats(parsed, window_duration, slide_duration).orderBy(
        "window_start", "service")


def hopping_success_rate(df: DataFrame, window_duration: str, slide_duration: str, *,
                         truncate_to_second: bool = True) -> DataFrame:
    """Hopping windows: ``slide < duration``; each row lands in several windows."""
    return windowed_success_rate(df, window_duration, slide_duration, truncate_to_second=truncate_to_second)
