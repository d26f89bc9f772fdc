"""Cutting lineage: a table written to the cluster's shared checkpoint folder.

Used for small intermediate tables that several branches read (each branch
prunes different columns, which defeats exchange reuse and would recompute
the input).  The table is written once as Parquet under
``spark.checkpoint.dir`` and read back: the plan downstream shrinks to a
file scan, the input is computed exactly once (an eager ``checkpoint()``
computes it twice unless cached), and a lost executor re-reads the files
instead of recomputing the lineage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from loglens.session import scratch_path

_WRITTEN: list[tuple[SparkSession, str]] = []  # tables that a running ``tidied`` function removes
_depth = 0


def materialize(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, f"mat-{name}")
    if _depth:
        _WRITTEN.append((spark, path))
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def tidied(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``operator`` with its result written, and every other table that it wrote removed."""

    @wraps(operator)
    def run(*args, **kwargs) -> DataFrame:
        global _depth
        before, kept = len(_WRITTEN), []
        _depth += 1
        try:
            out = materialize(operator(*args, **kwargs), operator.__name__)
            kept = _WRITTEN[-1:]
            return out
        finally:
            for spark, path in _WRITTEN[before:len(_WRITTEN) - len(kept)]:
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            _depth -= 1
            _WRITTEN[before:] = kept if _depth else []

    return run
