from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

BASE = 1_761_498_000.0  # a fixed epoch second; fixture times are offsets from it


@pytest.fixture(scope="session")
def spark():
    from pyspark import SparkConf
    from pyspark.sql import SparkSession

    builder = SparkSession.builder
    if not SparkConf().get("spark.checkpoint.dir", None):
        # static setting: only set where the environment names none
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loglens-test-ckpt-"))
    spark = (
        builder.master("local[4]")
        .appName("loglens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark


def ev(service="monitoring", t=None, code=None, message=None, **extra):
    """One event dict; ``t`` is an offset in seconds from BASE."""
    e = {}
    if service is not None:
        e["service"] = service
    if t is not None:
        e["timestamp"] = BASE + t
    if message is not None:
        e["message"] = message
    elif code is not None:
        e["message"] = f"HTTP Status Code: {code}"
    e.update(extra)
    return e


def events_df(spark, batches):
    """Batches (lists of event dicts) -> log view rows with batch_id, pos, event_id."""
    rows = []
    eid = 0
    for b, batch in enumerate(batches):
        for p, e in enumerate(batch):
            rows.append((eid, b, p, e.get("service"), e.get("timestamp"), e.get("message")))
            eid += 1
    return spark.createDataFrame(
        rows, "event_id bigint, batch_id bigint, pos bigint, service string, timestamp double, message string")


def write_json(path, name, payload, raw=False):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(payload if raw else json.dumps(payload))
