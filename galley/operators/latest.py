"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

LINEAGE = ("_loaded_at", "_batch_id", "_source_file")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str | Column] = LINEAGE
) -> DataFrame:
    """Keep one row per key: the first by ``newest`` descending, NULLs last.

    NULL keys form one group. A hash of the row closes the order, so equal candidates
    give the same winner on every attempt of a task. The ``= 1`` filter lets Spark trim
    each group to one row before the shuffle (``WindowGroupLimit``), which keeps a key
    with very many versions cheap.
    """
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in newest]
    tie = F.xxhash64(*[F.col(c) for c in df.columns]).desc()
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order, tie))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")
