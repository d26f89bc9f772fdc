"""Schemas and fixed values of the log model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the values of the log format being analysed) ---
# Services and status codes of the logs.
SERVICES = ["training", "evaluation", "inference", "monitoring"]
STATUS_CODES = [200, 201, 202, 203, 400, 401, 402, 403, 404, 500]
# The message tag and the regex form of the status code.
STATUS_TAG = "HTTP Status Code: "
STATUS_REGEX = r"HTTP Status Code:\s*(\d+)"
# The message whose presence marks a non-failure in the sliding-window count.
OK_MESSAGE = "HTTP Status Code: 200"
# Defaults for missing keys.
DEFAULT_SERVICE = "unknown_service"
DEFAULT_MESSAGE = ""
DEFAULT_TIMESTAMP = 0.0
# Service reported by the single-value running and sliding results.
TARGET_SERVICE = "monitoring"
# Trailing window of the sliding failure count, seconds.
SLIDING_WINDOW_SECONDS = 60
# Sample size of the reservoir.
RESERVOIR_SIZE = 10
# Bloom filter defaults (bits, hashes).
BLOOM_BITS = 1_000_000
BLOOM_HASHES = 7
# Streaming defaults of the windowed success rate.
WINDOW_DURATION = "10 seconds"
SLIDE_DURATION = "10 seconds"
WATERMARK = "30 seconds"
MAX_FILES_PER_TRIGGER = 10
TRIGGER_INTERVAL = "1 second"
# Seed of the sample keys.
GENERATOR_SEED = 42
# --- end of fixed values ---

# One log event.  The parsers never infer a schema; missing keys come back null.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("service", T.StringType(), True),
        T.StructField("timestamp", T.DoubleType(), True),
        T.StructField("message", T.StringType(), True),
    ]
)

# DDL of one JSON file: an array of events (a bare object is accepted too).
LOG_ARRAY_DDL = "array<struct<service:string,timestamp:double,message:string>>"

# The single-value result of the running, sliding, sample and Bloom operators.
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("value", T.DoubleType(), True),
        T.StructField("newest_considered", T.TimestampNTZType(), True),
        T.StructField("oldest_considered", T.TimestampNTZType(), True),
    ]
)
