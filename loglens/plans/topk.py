"""Running bottom-k: the ``k`` smallest items seen up to each place of an order, as rows.

Items are rows (order, key columns, payload); the answer has up to ``k`` rows for each
place, so that many rows are the least any form handles.  Orders are cut into blocks of
``width``; a place's answer is the bottom ``k`` of what its block inherits (the bottom ``k`` of all blocks
before, found the same way one level up) and of its block's own items up to the place.
Own items that ``k`` inherited ones precede can never enter and go first, so beyond the first blocks
a place sees little more than the ``k`` rows it returns.  Ranks are windows over one place: Spark
sorts its rows with spilling and limits groups before the shuffle, and no row ever holds a list,
so ``k`` may be as large as a task can sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglens.plans.materialize import materialize


def levels_for(span: int, width: int) -> int:
    """Block levels so that a block and the top hold at most ``width`` places."""
    if span <= width:
        return 0
    return max(1, math.ceil(math.log(span / width) / math.log(width)))


def bottom_k(rows: DataFrame, by: str, key: Sequence[str], k: int) -> DataFrame:
    """The ``k`` smallest rows of each ``by`` (a group limit that Spark also applies before the shuffle)."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*key))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def _seen(rows: DataFrame, places: DataFrame, order: str, block: str, exclusive: bool) -> DataFrame:
    """Each row at every later place of its block (or, exclusive of its own, at its own too)."""
    later = F.col("_place") > F.col(order) if exclusive else F.col("_place") >= F.col(order)
    return (rows.join(places.select(F.col(order).alias("_place"), F.col(block)), block).where(later)
            .drop(order).withColumnRenamed("_place", order))


def prefix_bottom_k(rows: DataFrame, order: str, key: Sequence[str], k: int, *, places: DataFrame | None = None,
                    width: int = 32, levels: int = 1, exclusive: bool = False) -> DataFrame:
    """For each of ``places`` (default: the orders of ``rows``) the bottom ``k``, by ``key``, of the rows with
    order <= (or <) it; ``rows`` hold at most ``k`` rows an order, or more that are sorted away here."""
    block = f"_block{levels}"
    cut = (F.floor(F.col(order) / width) if levels > 0 else F.lit(0)).cast("bigint")
    d = materialize(bottom_k(rows, order, key, k).withColumn(block, cut), "bottom-k")
    if places is None:
        places = d.select(order).distinct()
    places = materialize(places.select(order).withColumn(block, cut), "bottom-k-places")
    if levels <= 0:
        return bottom_k(_seen(d, places, order, block, exclusive).drop(block), order, key, k)
    summary = bottom_k(d.drop(order), block, key, k).withColumnRenamed(block, order)
    above = materialize(prefix_bottom_k(summary, order, key, k, places=places.select(F.col(block).alias(order)).distinct(), width=width,
                                        levels=levels - 1, exclusive=True).withColumnRenamed(order, block), "bottom-k-inherited")
    last = F.struct(*key)
    full = above.groupBy(block).agg(F.count("*").alias("_n"), F.max(last).alias("_last")).where(F.col("_n") == k).drop("_n")
    own = d.join(full, block, "left").where(F.col("_last").isNull() | (last < F.col("_last"))).drop("_last")
    inherited = above.join(places, block).drop(block)
    seen = _seen(own, places, order, block, exclusive).drop(block)
    return bottom_k(inherited.unionByName(seen), order, key, k)
