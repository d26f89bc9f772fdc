"""JSON log files: one file = one batch, holding a JSON array of events or a
single event object.

Batch and stream share one parser.  Each file is read whole
(``wholetext``), parsed with the fixed log schema (``from_json``, never
inferred) and exploded with its position, so ``(file, pos)`` identifies an
event even when contents repeat.  Files that are not exactly one JSON value
of the right shape are quarantined, not fatal.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.plans.rank import with_rank
from loglens.schema import LOG_ARRAY_DDL
from loglens.session import few_listing_tasks
from loglens.sources import split_json

FILE_COLS = ["file_path", "file_name", "file_modified"]


def read_raw_files(spark: SparkSession, path: str | list[str], *, glob: str | None = "*.json",
                   recursive: bool = False) -> DataFrame:
    """One row per file: ``value`` (whole text) plus file metadata.

    Partition directories (``key=value``) become columns unless ``recursive``.
    """
    few_listing_tasks(spark)
    opts = {"wholetext": True}
    if glob:
        opts["pathGlobFilter"] = glob
    if recursive:
        opts["recursiveFileLookup"] = True
    raw = spark.read.text(path, **opts)
    return raw.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
    )


def finite(c: Column) -> Column:
    """Non-finite numbers (``NaN``, ``Infinity``, accepted by JSON parsers) as
    null: they would otherwise win every ``max`` and poison running spans."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def _single_value(text: Column) -> Column:
    """True when ``text`` is exactly one JSON value (``from_json`` alone would
    accept a JSON-lines file by keeping its first object).

    Wrapped in brackets, one value is a one-element array, and a two-element array
    with another value behind it; text that closes the bracket itself cannot be both, and anything
    else is invalid or longer.  ``json_array_length`` streams over the tokens
    without materialising them; its tokenizer rejects ``NaN``/``Infinity``,
    which the JSON parsers accept, so files it rejects get a second,
    permissive check (only those: malformed files, or non-finite numbers).
    """

    def holds(wrapped: Column, n: int) -> Column:
        permissive = F.size(F.from_json(wrapped, "array<string>")) == n
        return F.coalesce(F.json_array_length(wrapped) == n, permissive, F.lit(False))

    return (holds(F.concat(F.lit("["), text, F.lit("]")), 1)
            & holds(F.concat(F.lit("["), text, F.lit(",0]")), 2))


def _events(text: Column) -> Column:
    """The events of a text that is one JSON array of objects or one object, else null
    (strings in single quotes are not JSON)."""
    return F.when(_single_value(text), F.from_json(text, LOG_ARRAY_DDL, {"allowSingleQuotes": "false"}))


def _parsed(raw: DataFrame) -> DataFrame:
    return raw.withColumn("_events", _events(F.col("value")))


def parse_log_files(raw: DataFrame) -> DataFrame:
    """Events of the well-formed files: file columns, ``pos``, service,
    timestamp, message.  ``[]`` yields no rows; a bare object one row;
    null array elements are skipped."""
    keep = [c for c in raw.columns if c != "value"]
    # outer: for the inner form Spark adds a filter on the array, which parses each file three times
    exploded = _parsed(raw).select(*keep, F.posexplode_outer("_events").alias("pos", "_e"))
    return exploded.where(F.col("_e").isNotNull()).select(
        *keep,
        F.col("pos").cast("bigint").alias("pos"),
        F.col("_e.service").alias("service"),
        finite(F.col("_e.timestamp")).alias("timestamp"),
        F.col("_e.message").alias("message"),
    )


def quarantine_files(raw: DataFrame) -> DataFrame:
    """Files that are not one JSON array/object of log events, with their text."""
    keep = [c for c in raw.columns if c != "value"]
    return _parsed(raw).where(F.col("_events").isNull()).select(*keep, "value")


def empty_files(spark: SparkSession, path: str, *, glob: str | None = "*.json",
                recursive: bool = False) -> DataFrame:
    """Zero-byte files ``(file_path, file_name)``.

    ``wholetext`` yields no row for them and Spark's file sources skip empty
    files when planning splits, so they never reach
    :func:`quarantine_files`.  They are found in the file listing (metadata
    the driver lists for any file source anyway), not by reading data.
    """
    import fnmatch

    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    it = fs.listFiles(root, bool(recursive))
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if st.getLen() == 0 and (not glob or fnmatch.fnmatch(name, glob)):
            found.append((st.getPath().toString(), name))
    return spark.createDataFrame(found, "file_path string, file_name string")


def read_logs(spark: SparkSession, path: str | list[str], *, glob: str | None = "*.json",
              recursive: bool = False, require_files: bool = False,
              parser: str = "wholetext") -> DataFrame:
    """All events of all log files under ``path`` (batch form of the stream).

    ``require_files`` raises when nothing matches, like a batch job that must
    not silently report on no input.  ``parser="multiline"`` reads a file in pieces
    instead of holding it as one value, by the same contract: for
    files too large for one row or task (a source holding a large share of the data).
    """
    if parser == "multiline":
        events = read_logs_multiline(spark, path, glob=glob, recursive=recursive)
        if require_files and _no_files(spark, path, glob, recursive):
            raise FileNotFoundError(f"no log files matching {glob!r} under {path}")
        return events
    raw = read_raw_files(spark, path, glob=glob, recursive=recursive)
    if require_files and raw.select("file_path").isEmpty():
        raise FileNotFoundError(f"no log files matching {glob!r} under {path}")
    return parse_log_files(raw)


def _no_files(spark: SparkSession, path, glob, recursive) -> bool:
    """Whether nothing matches, from the listing (a file may hold no event)."""
    few_listing_tasks(spark)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(bool(recursive)).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load([path] if isinstance(path, str) else list(path)).select("path").isEmpty()


def read_logs_multiline(spark: SparkSession, path: str | list[str], *, glob: str | None = "*.json",
                        recursive: bool = False) -> DataFrame:
    """Events of :func:`read_logs`, file by file the same, from files read in pieces
    (:mod:`loglens.sources.split_json`)."""
    found = split_json.read_events(spark, path, glob, recursive, _events)
    return found.select(*FILE_COLS, "pos", F.col("e.service").alias("service"),
                        finite(F.col("e.timestamp")).alias("timestamp"), F.col("e.message").alias("message"))


def quarantine_files_multiline(spark: SparkSession, path: str | list[str], *,
                               glob: str | None = "*.json", recursive: bool = False) -> DataFrame:
    """Files that :func:`quarantine_files` sets aside, with their text, from files read in pieces."""
    return split_json.malformed_files(spark, path, glob, recursive, _events)


def number_files(spark: SparkSession, path: str | list[str], *, glob: str | None = "*.json",
                 recursive: bool = False, order: tuple[str, ...] = ("file_modified", "file_path")) -> DataFrame:
    """``file_path, file_name, file_modified, batch_id``: the files numbered 0, 1, ... in
    ``order``, from their metadata alone (no content is read or parsed)."""
    few_listing_tasks(spark)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    paths = [path] if isinstance(path, str) else list(path)
    files = reader.load(paths).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_modified"))
    return with_rank(files, [F.asc(c) for c in order], "file-numbers", "batch_id")


def file_batches(events: DataFrame, order: tuple[str, ...] = ("file_modified", "file_path"),
                 numbers: DataFrame | None = None) -> DataFrame:
    """Dense, order-preserving ``batch_id`` per file, joined onto ``events``.

    ``numbers`` (from :func:`number_files`) spares listing the files from the
    parsed events.  Operators that sum per file take ``numbers`` themselves and
    join them to the sums instead.
    """
    if numbers is None:
        files = events.select(*FILE_COLS).distinct()
        numbers = with_rank(files, [F.asc(c) for c in order], "file-batches", "batch_id")
    return events.drop("batch_id").join(numbers.select("file_path", "batch_id"), "file_path")


def unprocessed_files(listed: DataFrame, processed: DataFrame, key: str = "file_path") -> DataFrame:
    """Listed files not yet processed (anti-join on the file key)."""
    return listed.join(processed.select(key).distinct(), key, "left_anti")


def json_array_lines(events: DataFrame, batch: str = "batch_id", pos: str = "pos", tasks: int | None = None) -> DataFrame:
    """Text lines that make each batch one JSON array: ``[{..}``, ``,{..}``, ``..}]``.

    Missing values are left out of the objects (missing key = null).  With ``tasks`` the batches
    are dealt to so many partitions (default: as many as their bytes need).
    """
    from pyspark.sql import Window

    if tasks:
        events = events.repartition(tasks, batch)
    obj = F.to_json(F.struct("service", "timestamp", "message"))
    w = Window.partitionBy(batch)
    first = F.col(pos) == F.min(pos).over(w)
    last = F.col(pos) == F.max(pos).over(w)
    line = F.concat(F.when(first, F.lit("[")).otherwise(F.lit(",")), obj,
                    F.when(last, F.lit("]")).otherwise(F.lit("")))
    return events.select(batch, pos, line.alias("line"))


def write_batch_files(lines: DataFrame, path: str, batch: str = "batch_id", pos: str = "pos",
                      mode: str = "errorifexists", clustered: bool = False, tasks: int | None = None,
                      folder_a_batch: bool = True) -> None:
    """One file per batch under ``path/<batch>=<id>/``, lines in position order.

    ``clustered`` says the rows of each batch already sit in one partition
    (as :func:`json_array_lines` leaves them); otherwise one shuffle on the
    batch co-locates them first, in ``tasks`` partitions.

    Small files cost by their number, not their bytes, which is what Spark sizes partitions by: name
    ``tasks`` for many batches.  Each task moves its own files in place (commit algorithm 2); the driver
    would move them one by one.  A failed write may so leave some files: read a folder after its write.

    In a folder of the local file system (one that all executors see) the tasks write the files themselves: Hadoop's
    starts a ``chmod`` process for every folder and file that it makes, four a batch.  Other file systems
    and modes that replace files are left to Spark's writer.  Both make the same folders and texts.

    Folders cost more than files, to make and to list.  For readers that look up files recursively ``folder_a_batch=False``
    lets a task that writes the files itself keep them in one folder, as ``<batch>=<id>.<..>.txt``.
    """
    d = lines if clustered else lines.repartition(*([tasks] if tasks else []), batch)
    d = d.sortWithinPartitions(batch, pos).select(batch, "line")
    spark = d.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file" or mode not in ("error", "errorifexists", "append"):
        (d.write.mode(mode).option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(batch).text(path))
        return
    # Spark's writer, without rows, refuses or makes the folder as the mode says
    (d.limit(0).write.mode(mode)
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(batch).text(path))
    write = _local_writer(fs.makeQualified(root).toUri().getPath(), batch, folder_a_batch)
    (d.select(F.col(batch).cast("string").alias("batch"), "line").mapInArrow(write, "files bigint")
     .write.format("noop").mode("overwrite").save())
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(root, "_SUCCESS"), True).close()


def _local_writer(folder: str, batch: str, folder_a_batch: bool):
    """A function for ``mapInArrow`` over ``(batch, line)``, sorted by batch: writes each run of a batch to a new file
    in ``folder/<batch>=<id>`` (or in a folder of the task), a part of the rows at a time, and yields their number.

    A file gets its name when it is whole, so a task that runs again replaces its own files.  The function holds all
    it needs: workers need not have this package."""
    job = uuid.uuid4().hex

    def write(parts):
        import os
        import re

        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        def escaped(name: str) -> str:  # as Spark and Hive name the folder of a value
            return re.sub(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda m: f"%{ord(m.group()):02X}", name)

        task = TaskContext.get()
        now, out, at, name, files = None, None, None, None, 0

        def finish() -> None:
            out.close()
            os.replace(f"{at}/.{name}.{task.taskAttemptId()}", f"{at}/{name}")

        for part in parts:
            runs = pc.run_end_encode(part.column("batch"))
            ends = runs.run_ends.to_pylist()
            lines = pc.fill_null(part.column("line"), "")
            # the lines of a run as one text, each with its line break
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), lines), "\n")
            for value, text in zip(runs.values.to_pylist(), texts):
                if out is None or value != now:
                    if out is not None:
                        finish()
                    now, files = value, files + 1
                    where = f"{escaped(batch)}={escaped(value) if value else '__HIVE_DEFAULT_PARTITION__'}"
                    if folder_a_batch:
                        at, name = f"{folder}/{where}", f"part-{task.partitionId():05d}-{job}.c{files:03d}.txt"
                    else:
                        at, name = f"{folder}/part-{task.partitionId():05d}-{job}", f"{where}.c{files:03d}.txt"
                    os.makedirs(at, exist_ok=True)
                    out = open(f"{at}/.{name}.{task.taskAttemptId()}", "wb")
                out.write(text.as_buffer())
                out.write(b"\n")
        if out is not None:
            finish()
        yield pa.RecordBatch.from_pydict({"files": [files]})

    return write


def write_log_files(events: DataFrame, path: str, batch: str = "batch_id", pos: str = "pos",
                    mode: str = "errorifexists", tasks: int | None = None, folder_a_batch: bool = True) -> None:
    """Write events as JSON-array log files, one per batch (``.txt`` part files).

    One shuffle on the batch (the window that marks first and last lines), in ``tasks`` partitions."""
    write_batch_files(json_array_lines(events, batch, pos, tasks), path, batch, pos, mode, clustered=True,
                      folder_a_batch=folder_a_batch)
