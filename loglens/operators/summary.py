"""Batch success summary per service (the lazy-frame task)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.operators.parse import rate_inputs


def service_success_summary(df: DataFrame, **_unused: Any) -> DataFrame:
    """Per service: total, successes (status < 400), first/last event time, rate.

    Window, slide, watermark and file-rate options are accepted and ignored,
    as in the task this reproduces.  Incomplete rows (no service, status or
    time) are left out.  One shuffle on ``service``; the partial aggregate
    runs map-side, so a service holding most rows costs nothing extra.
    """
    p = rate_inputs(df, truncate_to_second=False)
    ok = F.col("_ok")
    return (
        p.groupBy("service")
        .agg(
            F.count(F.when(ok, 1)).alias("total"),
            F.sum(F.when(ok, F.col("is_success"))).cast("bigint").alias("successes"),
            F.min(F.when(ok, F.col("event_time"))).alias("window_start"),
            F.max(F.when(ok, F.col("event_time"))).alias("window_end"),
        )
        .where(F.col("service").isNotNull() & (F.col("total") > 0))
        .select(
            "service", "window_start", "window_end", "total", "successes",
            (F.col("successes") / F.col("total")).cast("double").alias("success_rate"),
        )
        .orderBy("service")
    )
