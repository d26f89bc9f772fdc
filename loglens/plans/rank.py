"""Positions in a total order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglens.plans.materialize import materialize


def with_rank(df: DataFrame, order: list[Column], name: str, rank: str = "rank") -> DataFrame:
    """``df`` plus its 0-based position in the total order ``order`` (a bigint).

    Range partitions are numbered on their own and shifted by the rows before
    them, so no task sees more than one partition's rows; the only
    unpartitioned window runs over one row per partition.
    """
    parts = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    before = (parts.groupBy("_part").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n"))
              .select("_part", "_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (parts.withColumn("_i", inside).join(before, "_part")
            .withColumn(rank, (F.col("_before") + F.col("_i") - 1).cast("bigint"))
            .drop("_part", "_i", "_before"))
