"""Pattern lists: a text file, one pattern per line, stripped, blanks skipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.functions.status import PY_WHITESPACE

_STRIP = f"^[{PY_WHITESPACE}]+|[{PY_WHITESPACE}]+$"


def strip_text(c: Column | str) -> Column:
    """Python ``str.strip()``: leading/trailing whitespace of the Python set."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, _STRIP, "")


def patterns_from_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    s = strip_text(col)
    return lines.select(s.alias("pattern")).where(F.col("pattern") != "")


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """Patterns of a text file (or folder of them); a missing path raises."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        raise FileNotFoundError(f"pattern file not found: {path}")
    return patterns_from_lines(spark.read.text(path))
