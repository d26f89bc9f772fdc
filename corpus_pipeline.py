"""A corpus pipeline over ``documents``, built from the training-data operators.

Each stage takes the documents that the one before kept, and its decisions take
effect; every stage but the last returns the columns of ``documents``.  Every row
is a document of its own: decisions apply to rows, also where ids are missing or shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm.common import read, small_side, stage
from loglens.llm.decontaminate import contained_items
from loglens.llm.line_dedup import line_dedup
from loglens.llm.mixing import mix_sources
from loglens.llm.near_dup import near_duplicates
from loglens.llm.quality_rules import quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` and ``row``, a key of each row in the order of the ids: the id itself if a
    count finds that none is missing or shared, else the place in a copy that is written
    once, sorted by id (rows without one last)."""
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    if odd.limit(1).count() == 0:
        return docs.select(*COLUMNS, F.col("doc_id").alias("row"))
    # the random number deals out rows that share an id or have none; numbers rise with the range
    order = [F.asc_nulls_last("doc_id"), F.asc("deal")]
    return stage(docs.select(*COLUMNS, F.rand(1).alias("deal")).repartitionByRange(*order).sortWithinPartitions(*order)
                 .select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "rows")


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents whose row is not in ``rows``; the texts stay where they are if a count
    finds the rows few enough to broadcast."""
    rows = stage(rows.select("row").distinct(), "drop")
    return docs.join(small_side(rows), "row", "left_anti").select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    docs = _keyed(docs)
    labels = read(spark, sf_dir, "labels").join(docs.select("doc_id", "row"), "doc_id").select("row", "quality")
    verdicts = quality_rules(docs, labels, id_col="row")
    return _without(docs, verdicts.where("not kept"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; those left
    without a word go."""
    kept = line_dedup(_keyed(docs), id_col="row", extra=("doc_id", "lang", "source")).withColumnRenamed("kept", "text")
    return (kept.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
            .select("doc_id", "text", "lang", "source", F.char_length("text").cast("bigint").alias("n_chars")))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, similarity 0.8): the smallest id."""
    docs = _keyed(docs)
    verdicts = near_duplicates(docs, id_col="row", k=5, percent=80)
    return _without(docs, verdicts.where("not kept"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    docs = _keyed(docs)
    pairs = contained_items(docs, read(spark, sf_dir, "benchmark"), id_col="row")
    return _without(docs, pairs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words to take of each document in the mix of sources."""
    return mix_sources(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_dup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
]

#: Learned rules and hashed links are not SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
