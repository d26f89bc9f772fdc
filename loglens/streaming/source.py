"""File-stream source of JSON log files (same parser as the batch reader)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.schema import MAX_FILES_PER_TRIGGER
from loglens.session import few_listing_tasks
from loglens.sources.files import parse_log_files


BINARY_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def _uncompressed(spark: SparkSession, glob: str | None) -> bool:
    """Whether the files that ``glob`` takes end in an extension that names no compression."""
    end = re.search(r"\.\w+$", glob or "")
    if end is None:
        return False
    hadoop = spark._jvm.org.apache.hadoop
    codecs = hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    return codecs.getCodec(hadoop.fs.Path(f"log{end.group()}")) is None


def read_raw_stream(spark: SparkSession, path: str, *, glob: str | None = "*.json",
                    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                    recursive: bool = True) -> DataFrame:
    """One streaming row per new file: ``value`` (whole text) and file metadata.

    Spark's text reader copies Hadoop's configuration for every file, one task of a process at a time, which takes longer
    than a small file.  Its binary reader does not, and has the same bytes of every file that is not compressed."""
    few_listing_tasks(spark)
    # without a recursive lookup, folders may name columns like the binary reader's
    binary = recursive and _uncompressed(spark, glob)
    if binary:
        reader, value = spark.readStream.format("binaryFile").schema(BINARY_FILES), F.col("content").cast("string")
    else:
        reader, value = spark.readStream.format("text").option("wholetext", "true"), F.col("value")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).select(
        value.alias("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
    )


def read_log_stream(spark: SparkSession, path: str, *, glob: str | None = "*.json",
                    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                    recursive: bool = True, parser: str = "wholetext") -> DataFrame:
    """Streaming events ``(file_path, file_name, file_modified, pos, service,
    timestamp, message)``; each new file is read once.

    A streamed file is one value, whichever ``parser`` is named: reading files in pieces takes
    windows over a whole file, which a streaming plan has not.  Both parsers have one contract.
    """
    if parser not in ("wholetext", "multiline"):
        raise ValueError(f"unknown parser {parser!r}")
    return parse_log_files(read_raw_stream(spark, path, glob=glob,
                                           max_files_per_trigger=max_files_per_trigger,
                                           recursive=recursive))
