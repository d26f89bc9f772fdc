"""Session helpers: building a session and finding shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "loglens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests, benches and scripts (a cluster passes its own)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # one JVM: listing many partition folders in the driver beats a
        # listing job with one task per folder (clusters keep the default)
        conf["spark.sql.sources.parallelPartitionDiscovery.threshold"] = "100000"
        # the driver JVM is the whole engine in local mode (applies at JVM launch)
        conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


LISTING_TASKS_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def few_listing_tasks(spark: SparkSession) -> None:
    """Let a listing of many folders run in a few tasks a core (a session setting, kept if already set).

    Log files lie in a folder each.  Spark lists more than 32 folders in a job of a task a folder, up to
    10,000 tasks, which takes longer than listing them; a file stream lists its files the same way."""
    if spark.conf.get(LISTING_TASKS_CONF, None) is None:
        spark.conf.set(LISTING_TASKS_CONF, str(max(32, 4 * spark.sparkContext.defaultParallelism)))


#: Bytes that count as much as opening a file, and bytes of file listings that the driver keeps after their use.
SMALL_FILES_CONF = {"spark.sql.files.openCostInBytes": str(1 << 16), "spark.sql.hive.filesourcePartitionFileCacheSize": "0"}


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside read many small files with less on the driver (session settings: each kept if already set,
    else unset again).

    Small files are dealt out by their bytes, each counting 64 KB more.  Spark counts 4 MB, so a task gets
    4 to 32 log files, and the driver keeps figures of every task that has run.  Listings are not cached: the
    cache, of up to 250 MB, serves tables of a catalog and holds each listing of a folder anew."""
    own = {k: v for k, v in SMALL_FILES_CONF.items() if spark.conf.get(k, None) is None}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in own:
            spark.conf.unset(k)


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Read from the session (it is a static setting).  Only a local-mode
    session that names none gets a fresh local folder, registered as the
    SparkContext checkpoint directory; a cluster session without one is an
    error, never a silent machine-local fallback.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder shared by all executors "
                "(e.g. on HDFS or an object store); a machine-local folder would lose data")
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS.get(app)
        if root is None:
            root = tempfile.mkdtemp(prefix="loglens-ckpt-")
            _LOCAL_ROOTS[app] = root
            spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/loglens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path in this application's part of the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession, prefix: str = "") -> None:
    """Remove this application's scratch tables (those whose name starts with ``prefix``).

    Call it when the results built from them have been written: plans that still
    read one of these tables cannot run afterwards."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return
    for st in fs.listStatus(root):
        if st.getPath().getName().startswith(prefix):
            fs.delete(st.getPath(), True)
