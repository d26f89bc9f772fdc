"""Sinks: the result log (CSV), result formatting, console output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.functions import format_timestamp, format_value


def result_log_rows(results: DataFrame, keep: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """Result rows as the result log writes them: ``value`` with four
    decimals, times as ``str(datetime)`` (micros only when non-zero)."""
    return results.select(
        *keep,
        format_value("value").alias("value_text"),
        format_timestamp("newest_considered").alias("newest_text"),
        format_timestamp("oldest_considered").alias("oldest_text"),
    )


def result_display_rows(results: DataFrame, keep: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """The live-table form: ``%.4f`` and ``YYYY-MM-DD HH:MM:SS``."""
    return results.select(
        *keep,
        format_value("value").alias("value_text"),
        format_timestamp("newest_considered", with_micros=False).alias("newest_text"),
        format_timestamp("oldest_considered", with_micros=False).alias("oldest_text"),
    )


def _log_lines(results: DataFrame) -> DataFrame:
    line = F.concat_ws(",", format_timestamp(F.localtimestamp()), "value_text", "newest_text", "oldest_text")
    return result_log_rows(results, keep=()).select(line.alias("value"))


def append_results_log(results: DataFrame, path: str) -> None:
    """Append ``processed_at, value, newest, oldest`` lines (CSV, no header)."""
    _log_lines(results).write.mode("append").text(path)


def write_log_epoch(results: DataFrame, path: str, epoch: int) -> None:
    """The log lines of a micro-batch, in ``path/epoch=<epoch>``: a replayed micro-batch
    replaces its lines, so each epoch is logged once."""
    _log_lines(results).write.mode("overwrite").text(f"{path.rstrip('/')}/epoch={epoch}")


def read_results_log(spark: SparkSession, path: str) -> DataFrame:
    """``epoch, processed_at, value_text, newest_text, oldest_text`` of a stream's log, in epoch order."""
    parts = F.split("value", ",")
    names = ("processed_at", "value_text", "newest_text", "oldest_text")
    return (spark.read.schema("value string, epoch bigint").text(path)
            .select("epoch", *[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(names)]).orderBy("epoch"))


#: CSV of results: a header, times with their microseconds (Spark's own format has milliseconds).
CSV_OPTIONS = {"header": "true", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def write_results(results: DataFrame, path: str, fmt: str = "csv") -> None:
    """The full result as CSV (``CSV_OPTIONS``) or Parquet files; ``path`` must be new."""
    w = results.write.mode("errorifexists")
    if fmt == "csv":
        w.options(**CSV_OPTIONS).csv(path)
    else:
        w.parquet(path)


def print_results(results: DataFrame) -> None:
    """Every row on the console, tab-separated under a header line; rows stream
    through the driver one partition at a time."""
    print("\t".join(results.columns))
    for row in results.toLocalIterator():
        print("\t".join("" if x is None else str(x) for x in row))


def show_results(results: DataFrame, n: int = 20) -> None:
    """A preview of ``n`` rows (``df.show``)."""
    results.show(n, truncate=False)
