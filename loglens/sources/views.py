"""Log views over the driver's ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` becomes a log
stream ``(event_id, batch_id, pos, service, timestamp, message)``:

* service: ``SERVICES[user_id mod 4]``; message: ``HTTP Status Code: <code>``
  with ``code = STATUS_CODES[k mod 10]``, ``k`` the first number in ``props``;
* timestamp: epoch seconds (double) of ``ts``; batch: ``event_id div 100``.

The *dirty* variant injects the cases the parsers must survive; the *late*
variant delays some events by one to three batches.  Every row of
``events`` is kept in every variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.functions.timefn import epoch_seconds
from loglens.schema import SERVICES, STATUS_CODES, STATUS_TAG

BATCH_SIZE = 100

# --- Fixed values: dirt injected by the dirty view, first match wins ---
# (event_id divisor, column, replacement)
DIRT_RULES = [
    (17, "message", "no code here"),
    (19, "message", "HTTP Status Code:404"),
    (23, "message", "HTTP Status Code: 302"),
    (29, "service", None),
    (31, "message", None),
    (41, "timestamp", None),
    (43, "timestamp", 0.0),
]
# Late view: events whose id divides by LATE_EVERY arrive 1 + id mod 3 batches late.
LATE_EVERY = 37
LATE_SPREAD = 3
# --- end of fixed values ---


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _batch(late: bool) -> Column:
    eid = F.col("event_id")
    b = F.floor(eid / BATCH_SIZE)
    if late:
        b = b + F.when(eid % LATE_EVERY == 0, 1 + eid % LATE_SPREAD).otherwise(0)
    return b.cast("bigint")


def log_view(events: DataFrame, *, dirty: bool = False, late: bool = False) -> DataFrame:
    eid = F.col("event_id")
    services = F.array(*[F.lit(s) for s in SERVICES])
    codes = F.array(*[F.lit(c) for c in STATUS_CODES])
    k = F.regexp_extract("props", r"(\d+)", 1).try_cast("bigint")
    cols = {
        "service": F.element_at(services, (F.pmod(F.col("user_id"), F.lit(len(SERVICES))) + 1).cast("int")),
        "timestamp": epoch_seconds("ts"),
        "message": F.concat(F.lit(STATUS_TAG),
                            F.element_at(codes, (F.pmod(k, F.lit(len(STATUS_CODES))) + 1).cast("int")).cast("string")),
    }
    if dirty:
        kind = F.lit(None).cast("int")
        for idx, (div, _, _) in reversed(list(enumerate(DIRT_RULES))):
            kind = F.when(eid % div == 0, F.lit(idx)).otherwise(kind)
        for col in ("service", "timestamp", "message"):
            expr = cols[col]
            for idx, (_, target, value) in enumerate(DIRT_RULES):
                if target == col:
                    typ = "double" if col == "timestamp" else "string"
                    expr = F.when(kind == idx, F.lit(value).cast(typ)).otherwise(expr)
            cols[col] = expr
    return events.select(
        eid.alias("event_id"),
        _batch(late).alias("batch_id"),
        F.pmod(eid, F.lit(BATCH_SIZE)).alias("pos"),
        cols["service"].alias("service"),
        cols["timestamp"].alias("timestamp"),
        cols["message"].alias("message"),
    )


def load_log_view(spark: SparkSession, sf_dir: str, *, dirty: bool = False,
                  late: bool = False) -> DataFrame:
    return log_view(read_table(spark, sf_dir, "events"), dirty=dirty, late=late)
