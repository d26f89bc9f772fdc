"""Per-event projections and the incomplete-row filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.functions import (
    epoch_to_timestamp,
    epoch_to_timestamp_seconds,
    error_4xx_5xx,
    failure_not_ok_message,
    status_regex,
    status_strict,
    success_2xx,
    success_below_400,
)
from loglens.schema import DEFAULT_MESSAGE, DEFAULT_SERVICE, DEFAULT_TIMESTAMP


def parse_for_rates(df: DataFrame, *, truncate_to_second: bool = True,
                    service: str = "service", timestamp: str = "timestamp",
                    message: str = "message") -> DataFrame:
    """Regex status, event time and 0/1 success flag; incomplete rows dropped.

    ``truncate_to_second`` reproduces the ``from_unixtime`` parse of the
    windowed stream; ``False`` keeps the micros (batch summary).
    """
    to_ts = epoch_to_timestamp_seconds if truncate_to_second else epoch_to_timestamp
    return (
        df.withColumns({
            "status": status_regex(message),
            "event_time": to_ts(timestamp),
        })
        .dropna(subset=[service, "status", "event_time"])
        .withColumn("is_success", success_below_400("status"))
    )


def rate_inputs(df: DataFrame, *, truncate_to_second: bool = True) -> DataFrame:
    """``service, status, event_time, is_success`` plus ``_ok`` (the row is
    complete) without filtering.

    Aggregations count only ``_ok`` rows and drop empty groups afterwards.
    A ``dropna`` filter would be pushed below the projection by inlining the
    status regex, which is then evaluated twice per row; this way it runs once.
    """
    to_ts = epoch_to_timestamp_seconds if truncate_to_second else epoch_to_timestamp
    p = df.select("service", status_regex("message").alias("status"),
                  to_ts("timestamp").alias("event_time"))
    ok = F.col("service").isNotNull() & F.col("status").isNotNull() & F.col("event_time").isNotNull()
    return p.select("*", ok.alias("_ok"), success_below_400("status").alias("is_success"))


def outcome_flags(df: DataFrame, message: str = "message") -> DataFrame:
    """All four success/failure definitions side by side."""
    code = status_strict(message)
    status = status_regex(message)
    return df.withColumns({
        "success_2xx": success_2xx(code),
        "failure_not_200": failure_not_ok_message(message),
        "success_below_400": success_below_400(status),
        "error_4xx_5xx": error_4xx_5xx(status),
    })


def log_defaults(df: DataFrame) -> DataFrame:
    """Missing keys take their defaults (service, message, timestamp)."""
    return df.select(
        *[c for c in df.columns if c not in ("service", "message", "timestamp")],
        F.coalesce("service", F.lit(DEFAULT_SERVICE)).alias("service"),
        F.coalesce("message", F.lit(DEFAULT_MESSAGE)).alias("message"),
        F.coalesce("timestamp", F.lit(DEFAULT_TIMESTAMP)).alias("timestamp"),
    )
