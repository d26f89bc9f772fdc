"""Batch runs over a growing folder: each run takes the files that no committed run has taken.

The manifest is a table of one folder per run (``run=<N>``: the files that the run took), written
once, after the run's output.  A run that fails before that has committed nothing: the next one
takes the same number, all its files and any that came since, and replaces its output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.plans.materialize import materialize
from loglens.session import scratch_path, small_files
from loglens.sources.files import number_files, read_logs, unprocessed_files

_FILES = "file_path string, file_name string, file_modified timestamp"
PATHS_A_READ = 10_000  # paths that the driver holds, and lists again, at once


def committed_runs(spark: SparkSession, manifest: str) -> list[int]:
    """Numbers of the runs whose file list is complete, ascending (one listing)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(manifest)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = (spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS") for s in fs.listStatus(path))
    return sorted(int(p.getParent().getName()[4:]) for p in done if p.getParent().getName().startswith("run=") and fs.exists(p))


def processed_files(spark: SparkSession, manifest: str) -> DataFrame:
    """``file_path, file_name, file_modified, run`` of all committed runs."""
    runs = committed_runs(spark, manifest)
    if not runs:
        return spark.createDataFrame([], f"{_FILES}, run bigint")
    return (spark.read.schema(_FILES).option("basePath", manifest).parquet(*[f"{manifest}/run={n}" for n in runs])
            .withColumn("run", F.col("run").cast("bigint")))


def run_new_files(spark: SparkSession, path: str, manifest: str, out: str, operator: Callable[[DataFrame], DataFrame], *,
                  glob: str | None = "*.json", recursive: bool = False, parser: str = "wholetext") -> int | None:
    """Apply ``operator`` to the events of the files that no committed run has taken, write its result to
    ``out/run=<N>`` and commit; the number of the run, None where no file is new.

    Files are told apart by path, so a file is taken once, whatever is written to it later.
    The paths of a run's new files pass through the driver, ``PATHS_A_READ`` at a time: the events of more files are
    staged, part by part, and ``operator`` gets them all at once."""
    with small_files(spark):
        listed = number_files(spark, path, glob=glob, recursive=recursive)
        # the paths of all earlier runs are not broadcast
        new = materialize(unprocessed_files(listed.hint("merge"), processed_files(spark, manifest))
                          .select(*[c.split()[0] for c in _FILES.split(", ")]), "new-files")
        paths = (r.file_path for r in new.select("file_path").toLocalIterator())
        parts = iter(lambda: list(islice(paths, PATHS_A_READ)), [])
        first, second = next(parts, []), next(parts, [])
        if not first:
            return None
        run = max(committed_runs(spark, manifest), default=-1) + 1
        staged = scratch_path(spark, "mat-new-events") if second else None
        try:
            events = _staged_events(spark, chain([first, second], parts), staged, parser) if staged else read_logs(
                spark, first, glob=None, parser=parser)
            operator(events).write.mode("overwrite").parquet(f"{out}/run={run}")
        finally:
            if staged:
                folder = spark._jvm.org.apache.hadoop.fs.Path(staged)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        new.write.mode("overwrite").parquet(f"{manifest}/run={run}")
    return run


def _staged_events(spark: SparkSession, parts: Iterator[list[str]], staged: str, parser: str) -> DataFrame:
    """The events of all files of ``parts``, written to ``staged`` a part at a time."""
    for paths in parts:
        events = read_logs(spark, paths, glob=None, parser=parser)
        events.write.mode("append").parquet(staged)
    return spark.read.schema(events.schema).parquet(staged)


def read_runs(spark: SparkSession, manifest: str, out: str) -> DataFrame:
    """Results of all committed runs, with their ``run``."""
    return spark.read.option("basePath", out).parquet(*[f"{out}/run={n}" for n in committed_runs(spark, manifest)]).withColumn(
        "run", F.col("run").cast("bigint"))
