"""Distributed prefix scans (running sums / mins / maxes over an order).

A running aggregate over a global order is the core of the cumulative
operators.  A plain ``Window.orderBy`` without ``partitionBy`` would pull the
whole input into one task.  Instead the order key is cut into blocks:

1. inside a block, a window partitioned by the block computes the running
   aggregate (each task sees one block);
2. one row per block carries the block total; an *exclusive* running
   aggregate over the blocks gives each block its offset (recursively
   blocked again when there are many blocks);
3. offset and in-block value are combined after an equi-join on the block.

With one level (the default) the top window sees ``key range / width``
rows (one per block: a million batches of 1024 make 1,000 rows), bounded by
the key range, not by the data.  ``levels > 1`` blocks the block table again
for very long orders.  The input is shuffled in full once (by block, for the
window); block totals are a map-side partial aggregate (one row per block
per task), so their shuffle is small.  The offsets join uses plain equality
on the window's partitioning keys, so without a broadcast only the small
offsets side is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


def _combine(kind: str, offset: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(offset, F.lit(0)) + F.coalesce(local, F.lit(0))
    if kind == "min":
        return F.least(offset, local)
    return F.greatest(offset, local)


def prefix_scan(
    df: DataFrame,
    order_key: str,
    aggs: Sequence[tuple[str, str, str]],
    *,
    partition_by: Sequence[str] = (),
    tie_by: Sequence[str] = (),
    block_width: float = 1024,
    fanout: int = 1024,
    levels: int = 1,
    exclusive: bool = False,
    descending: bool = False,
) -> DataFrame:
    """Add running aggregates ``(out, kind, in)``, ``kind`` in sum/min/max.

    Rows are ordered by ``order_key`` (numeric, non-null) then ``tie_by``
    inside each ``partition_by`` group (non-null columns; coalesce first);
    ``exclusive`` leaves out the current row.  Rows
    with equal ``(order_key, tie_by)`` are ordered arbitrarily, so callers
    pass a unique order.  ``block_width`` is in units of ``order_key``.
    """
    blk = f"_blk{levels}"
    d = df.withColumn(blk, F.floor(F.col(order_key) / F.lit(block_width)).cast("bigint"))
    out = _scan(d, blk, [order_key, *tie_by], aggs, list(partition_by),
                fanout, levels, exclusive, descending)
    return out.drop(blk)


def _order(cols: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in cols]


def _scan(df, blk, order_cols, aggs, parts, fanout, levels, exclusive, descending):
    frame_end = -1 if exclusive else Window.currentRow
    w = (Window.partitionBy(*parts, blk).orderBy(*_order(order_cols, descending))
         .rowsBetween(Window.unboundedPreceding, frame_end))
    local = df.withColumns({f"_l_{o}": _AGG[k](F.col(i)).over(w) for o, k, i in aggs})

    # block totals: Spark prunes the unused window column here, leaving a
    # partial aggregate of the input (one row per block per task)
    totals = local.groupBy(*parts, blk).agg(*[_AGG[k](F.col(i)).alias(f"_t_{o}") for o, k, i in aggs])
    t_aggs = [(f"_o_{o}", k, f"_t_{o}") for o, k, _ in aggs]
    if levels > 1:
        up = f"_blk{levels - 1}"
        totals = totals.withColumn(up, F.floor(F.col(blk) / F.lit(fanout)).cast("bigint"))
        offsets = _scan(totals, up, [blk], t_aggs, parts, fanout, levels - 1, True, descending).drop(up)
    else:
        wt = (Window.partitionBy(*parts).orderBy(*_order([blk], descending))
              .rowsBetween(Window.unboundedPreceding, -1))
        offsets = totals.withColumns({o: _AGG[k](F.col(i)).over(wt) for o, k, i in t_aggs})
    offsets = offsets.select(*[F.col(c).alias(f"_k_{c}") for c in (*parts, blk)],
                             *[f"_o_{o}" for o, _, _ in aggs])

    # plain equality: the keys match the window's partitioning, so a
    # sort-merge join (when the offsets are too big to broadcast) only
    # shuffles the small side; null-safe keys would re-shuffle the input
    cond = [F.col(c) == F.col(f"_k_{c}") for c in (*parts, blk)]
    joined = local.join(offsets, on=cond, how="left")
    return joined.select(
        *df.columns,
        *[_combine(k, F.col(f"_o_{o}"), F.col(f"_l_{o}")).alias(o) for o, k, _ in aggs],
    )
