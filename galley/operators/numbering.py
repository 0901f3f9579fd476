"""Dense numbers and ranks without a single-task sort.

Rows are range-partitioned and sorted, and each row's partition and offset are pinned.
Sizes of the partitions then give every row its place in the total order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from galley.operators.durable import pin

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row number below


def _laid_out(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return pin(placed).withColumns(
        {
            "_block": F.shiftright("_at", _ROW_BITS),
            "_slot": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    ).drop("_at")


def dense_number(
    df: DataFrame, order: Sequence[Column], name: str, start: int = 1
) -> DataFrame:
    """Number all rows ``start, start + 1, ...`` in the given total order."""
    rows = _laid_out(df, order)
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    # one row per partition, so both the window and the broadcast are small
    offsets = (
        rows.groupBy("_block")
        .agg(F.count("*").alias("_n"))
        .select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_skip"))
    )
    number = (F.col("_skip") + F.col("_slot") + F.lit(start)).cast("bigint")
    return (
        rows.join(F.broadcast(offsets), "_block")
        .withColumn(name, number)
        .drop("_block", "_slot", "_skip")
    )


def rank_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """``row_number`` per key for keys of any size.

    A key with very many rows spans several range partitions; no task has to hold all
    its rows. NULL keys form one group.
    """
    rows = _laid_out(df, [*[F.col(k).asc_nulls_last() for k in keys], *order])
    earlier = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        rows.groupBy("_block", *keys)
        .agg(F.count("*").alias("_n"), F.min("_slot").alias("_first"))
        .withColumn("_skip", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(
            F.col("_block").alias("_b"),
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            "_first",
            "_skip",
        )
    )
    same = F.col("_block") == F.col("_b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rank = (F.col("_slot") - F.col("_first") + F.col("_skip") + F.lit(1)).cast("bigint")
    return rows.join(blocks, same).withColumn(name, rank).select(*df.columns, name)
