"""As-of lookup: for each query key, the smallest value among records with a
strictly greater key.

Spark has no as-of join.  Queries and records are unioned and scanned in
descending key order with an *exclusive* running ``min`` (the blocked prefix
scan), queries sorting before records on equal keys so an equal key never
matches.  No pairs are formed: every row is sorted once inside its key block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.plans.scan import prefix_scan


def min_after(queries: DataFrame, query_key: str, records: DataFrame, record_key: str,
              record_value: str, out: str, *, block_width: float,
              partition_by: Sequence[str] = (), levels: int = 1,
              fanout: int = 1024) -> DataFrame:
    """Add ``out`` = min(record_value) over records with key > query key
    (null when there is none) to every query row."""
    qcols = [c for c in queries.columns if c not in partition_by]
    key, val, isq = "_asof_key", "_asof_val", "_asof_isq"
    vtype = records.schema[record_value].dataType
    q = queries.select(
        *partition_by, *qcols,
        F.col(query_key).cast("double").alias(key),
        F.lit(None).cast(vtype).alias(val), F.lit(1).alias(isq))
    r = records.select(
        *partition_by,
        *[F.lit(None).cast(queries.schema[c].dataType).alias(c) for c in qcols],
        F.col(record_key).cast("double").alias(key),
        F.col(record_value).alias(val), F.lit(0).alias(isq))
    scanned = prefix_scan(q.unionByName(r), key, [(out, "min", val)],
                          partition_by=partition_by, tie_by=[isq],
                          block_width=block_width, levels=levels, fanout=fanout,
                          exclusive=True, descending=True)
    return scanned.where(F.col(isq) == 1).select(*partition_by, *qcols, out)
