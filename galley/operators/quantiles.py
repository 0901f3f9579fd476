"""Exact quantiles without sorting a table.

A value at a rank is sought by narrowing: a sketch cuts the range it lies in into about equal
shares, an exact count per share tells which one holds the rank, and the next pass looks at
that share only. Values equal to a cut are a share of their own, so ties end the search at
once. Only counts and cuts, some dozen per pass and quantile, come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from galley.operators.durable import scratch

SHARES = 32


@dataclass(frozen=True)
class _Range:
    """Values strictly between two bounds, and how many come before and in it."""

    low: Any
    high: Any
    before: int
    size: int

    def holds(self, value: Column) -> Column:
        inside = value.isNotNull()
        if self.low is not None:
            inside = inside & (value > F.lit(self.low))
        return inside if self.high is None else inside & (value < F.lit(self.high))


def exact_quantiles(
    df: DataFrame, column: str, percents: Sequence[int], name: str, small: int = 100_000
) -> DataFrame:
    """``percentile, name``: the value of rank ``ceil(n * percentile / 100)``, ties counted each.

    NULLs take no part; without values, or for percentile 0, there is no row. Values must not
    be NaN. ``small`` is the number of rows a range may have to be sorted by one task.
    """
    spark = df.sparkSession
    with scratch(spark) as keep_rows:
        values = keep_rows(df.select(F.col(column).alias("_value")).where("_value IS NOT NULL"))
        size = values.count()
        ranks = {p: -(-size * p // 100) for p in percents}
        found = _search(values, {r for r in ranks.values() if r > 0}, size, small)
    kind = df.schema[column].dataType.simpleString()
    rows = [(p, found[r]) for p, r in ranks.items() if r in found]
    return spark.createDataFrame(rows, f"percentile int, `{name}` {kind}")


def _search(values: DataFrame, ranks: set[int], size: int, small: int) -> dict[int, Any]:
    found: dict[int, Any] = {}
    wide = {_Range(None, None, 0, size): ranks} if ranks else {}
    narrow: dict[_Range, set[int]] = {}
    while wide:
        large = {r: wanted for r, wanted in wide.items() if r.size > small}
        narrow |= {r: wanted for r, wanted in wide.items() if r.size <= small}
        wide = {}
        if not large:
            break
        numbered = _numbered(values, list(large))
        cuts = _cuts(numbered)
        for (number, share), (start, count) in _counted(numbered, cuts).items():
            outer = list(large)[number]
            inside = {k for k in large[outer] if outer.before + start < k <= outer.before + start + count}
            if not inside:
                continue
            at, on_cut = divmod(share, 2)
            if on_cut:
                found |= dict.fromkeys(inside, cuts[number][at])
                continue
            low = cuts[number][at - 1] if at else outer.low
            high = cuts[number][at] if at < len(cuts[number]) else outer.high
            wide[_Range(low, high, outer.before + start, count)] = inside
    if narrow:
        found |= _sorted(values, narrow)
    return found


def _numbered(values: DataFrame, ranges: list[_Range]) -> DataFrame:
    """Values of the ranges, which do not meet each other, with the number of theirs."""
    value = F.col("_value")
    number = reduce(lambda c, r: c.when(r[1].holds(value), r[0]), enumerate(ranges), F.when(F.lit(False), -1))
    return values.withColumn("_range", number).where("_range IS NOT NULL")


def _cuts(numbered: DataFrame) -> dict[int, list[Any]]:
    shares = [i / SHARES for i in range(SHARES + 1)]
    sketch = F.percentile_approx("_value", shares, 100 * SHARES)
    rows = numbered.groupBy("_range").agg(F.array_sort(F.array_distinct(sketch)).alias("cuts")).collect()
    return {r["_range"]: r["cuts"] for r in rows}


def _counted(numbered: DataFrame, cuts: dict[int, list[Any]]) -> dict[tuple[int, int], tuple[int, int]]:
    """Per range and share how many values come before it within the range, and how many it has.

    Share ``2 i`` lies below cut ``i``, share ``2 i + 1`` is the cut itself.
    """
    of_range = reduce(
        lambda c, item: c.when(F.col("_range") == item[0], F.array(*[F.lit(v) for v in item[1]])),
        cuts.items(),
        F,
    )
    below = F.filter("_cuts", lambda cut: cut < F.col("_value"))
    share = F.size(below) * 2 + F.array_contains("_cuts", F.col("_value")).cast("int")
    counted = numbered.withColumn("_cuts", of_range).groupBy("_range", share.alias("_share")).count()
    result, start, last = {}, 0, None
    for r in sorted(counted.collect(), key=lambda r: (r["_range"], r["_share"])):
        start = start if r["_range"] == last else 0
        result[r["_range"], r["_share"]] = (start, r["count"])
        start, last = start + r["count"], r["_range"]
    return result


def _sorted(values: DataFrame, ranges: dict[_Range, set[int]]) -> dict[int, Any]:
    """Values at ranks of small ranges."""
    every = list(ranges)
    place = F.row_number().over(W.partitionBy("_range").orderBy("_value"))
    ranked = _numbered(values, every).withColumn("_place", place)
    wanted = [(F.col("_range") == i) & F.col("_place").isin([k - r.before for k in ranges[r]]) for i, r in enumerate(every)]
    rows = ranked.where(reduce(lambda a, b: a | b, wanted)).collect()  # one per rank
    return {every[r["_range"]].before + r["_place"]: r["_value"] for r in rows}
