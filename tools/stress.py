"""Skew stress: the operators over a larger, deliberately skewed log view.

Derived from the driver's ``events`` table (every row repeated ``FACTOR``
times); a third of all events are moved into batch 0 with one shared
timestamp (a hot batch, a hot key and a hot time block at once), another third
keep their batch but all lose their timestamp (one time shared by all
batches), and nine of ten carry one message.
Usage: python tools/stress.py [sf_dir] [factor]
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    from pyspark.sql import functions as F

    from loglens.operators import bloom, running, sample, sliding, summary, windowed
    from loglens.session import build_session, scratch_path
    from loglens.sources.views import load_log_view

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    factor = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    spark = build_session("local[8]", app="loglens-stress", shuffle_partitions=8)
    v = load_log_view(spark, sf_dir, dirty=True)
    n = v.count()
    big = (v.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
           .withColumn("event_id", F.col("event_id") * factor + F.col("_j"))
           .withColumn("batch_id", F.floor(F.col("event_id") / 100).cast("bigint"))
           .drop("_j"))
    hot = F.pmod(F.col("event_id"), F.lit(3)) == 0
    big = (big.withColumn("batch_id", F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("batch_id")))
              .withColumn("timestamp", F.when(hot, F.lit(1_704_500_000.0))
                          .when(F.pmod(F.col("event_id"), F.lit(3)) != 1, F.col("timestamp")))
              .withColumn("message", F.when(F.pmod(F.col("event_id"), F.lit(10)) > 0, F.lit("HTTP Status Code: 500"))
                          .otherwise(F.col("message"))))
    path = scratch_path(spark, "stress")
    big.write.parquet(path)
    df = spark.read.parquet(path)
    rows = df.count()
    pats = df.where(F.col("service") == "monitoring").select(F.col("message").alias("pattern")).distinct()
    filt = bloom.bloom_build(pats, m_bits=500_000, k_hashes=8)
    runs = {
        "summary": lambda: summary.service_success_summary(df),
        "windowed": lambda: windowed.windowed_success_rate(df),
        "running_per_service": lambda: running.running_success_rate(df),
        "running_target": lambda: running.running_success_rate_target(df),
        "sliding_60s": lambda: sliding.sliding_failures(df, window_seconds=60),
        "sliding_rate_6h": lambda: sliding.sliding_failure_rate(df, window_seconds=21600),
        "sample": lambda: sample.reservoir_sample(df),
        "sample_by_batch": lambda: sample.reservoir_sample_by_batch(df),
        "bloom_hit_ratio": lambda: bloom.bloom_hit_ratio(df, filt, m_bits=500_000, k_hashes=8),
    }
    times = {}
    for name, fn in runs.items():
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 2)
    rate = {k: round(rows / v) for k, v in times.items() if v}
    print(json.dumps({"base_rows": n, "rows": rows, "factor": factor, "seconds": times,
                      "rows_per_sec": rate}))


if __name__ == "__main__":
    main()
