"""Versioned state tables for ``foreachBatch`` operators.

State after micro-batch ``e`` is written to ``<root>/state/v=<e>``; batch
``e`` reads ``v=<e-1>``.  A replayed micro-batch reads the same input
version and overwrites the same output version, so replays are idempotent.
Results are written to ``<root>/results/epoch=<e>`` the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    jp = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jp, jp.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Completed state versions (folders with ``_SUCCESS``), one listing."""
    jp, fs = _fs(spark, f"{root}/state")
    if not fs.exists(jp):
        return []
    out = []
    for st in fs.listStatus(jp):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v=") and fs.exists(
                spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name[2:]))
    return sorted(out)


def read_state(spark: SparkSession, root: str, epoch: int, schema: T.StructType) -> DataFrame:
    """State as of the end of micro-batch ``epoch - 1``: the newest completed
    version below ``epoch`` (empty micro-batches write none); empty before
    the first.  A replay of ``epoch`` reads the same version."""
    below = [v for v in _versions(spark, root) if v < epoch]
    if not below:
        # not createDataFrame, whose tasks start Python workers for no rows
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.read.schema(schema).parquet(f"{root}/state/v={below[-1]}")


# versions kept behind the newest, like Spark's spark.sql.streaming.minBatchesToRetain
RETAIN_VERSIONS = 100


def write_state(df: DataFrame, root: str, epoch: int, retain: int | None = RETAIN_VERSIONS) -> DataFrame:
    """Write version ``epoch``; drop versions more than ``retain`` micro-batches
    back, except the predecessor of ``epoch`` (a replay of ``epoch`` reads it)."""
    spark = df.sparkSession
    p = f"{root}/state/v={epoch}"
    df.write.mode("overwrite").parquet(p)
    if retain is not None:
        versions = _versions(spark, root)
        below = [v for v in versions if v < epoch]
        keep_pred = below[-1] if below else None
        for v in versions:
            if v < epoch - retain and v != keep_pred:
                old, fs = _fs(spark, f"{root}/state/v={v}")
                fs.delete(old, True)
    return spark.read.schema(df.schema).parquet(p)


def write_result(df: DataFrame, root: str, epoch: int, sub: str = "results",
                 retain: int | None = None) -> None:
    """Write micro-batch ``epoch``'s rows; with ``retain`` (complete mode, where an
    epoch holds the whole answer) drop epochs more than that many back."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{root}/{sub}/epoch={epoch}")
    if retain is not None:
        jp, fs = _fs(spark, f"{root}/{sub}")
        for st in fs.listStatus(jp):
            name = st.getPath().getName()
            if name.startswith("epoch=") and int(name.split("=", 1)[1]) < epoch - retain:
                fs.delete(st.getPath(), True)


def run_checkpoint(spark: SparkSession, root: str, checkpoint: str | None) -> str:
    """The checkpoint that belongs to the results under ``root`` (default: inside it).

    Results and state are only valid together with the checkpoint that made
    them, so a folder that holds some is refused without its checkpoint:
    a new run would mix its epochs with the old ones."""
    path = checkpoint or f"{root.rstrip('/')}/_checkpoint"
    jp, fs = _fs(spark, path)
    if not fs.exists(jp):
        for sub in ("results", "state", "per_service"):
            old, ofs = _fs(spark, f"{root}/{sub}")
            if ofs.exists(old):
                raise FileExistsError(f"{root} holds {sub} of a run whose checkpoint is not at {path}; "
                                      "name its checkpoint or a new output folder")
    return path


def read_results(spark: SparkSession, root: str) -> DataFrame:
    """All results written so far, with their ``epoch``."""
    return spark.read.parquet(f"{root}/results")


def last_epoch(spark: SparkSession, root: str, sub: str = "results") -> DataFrame:
    """Rows of the newest ``epoch=`` partition under ``root/sub`` (complete-mode
    sinks: the whole answer).  The newest epoch is found by listing the
    partition folders, so only that partition is read."""
    jp = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{sub}")
    fs = jp.getFileSystem(spark._jsc.hadoopConfiguration())
    epochs = []
    for st in fs.listStatus(jp):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("epoch="):
            epochs.append(int(name.split("=", 1)[1]))
    if not epochs:
        raise FileNotFoundError(f"no results under {root}/{sub}")
    return spark.read.parquet(f"{root}/{sub}/epoch={max(epochs)}")
