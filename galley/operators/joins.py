"""Key lookups that hold up under small, large and badly skewed sides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
HOT_ROWS = 2_000_000
NULL_KEY_SALTS = 1 << 20
# compressed columns take so many times their size as rows
EXPANSION = 4
# parts of the hash range in which rows are counted to rule hot keys out
SHARES = 1 << 16
LOOKUP_KINDS = ("left", "inner", "left_semi", "left_anti")


def planned_bytes(df: DataFrame) -> int:
    """Size of ``df`` in memory, from what Catalyst knows: of a stored table, its files times ``EXPANSION``."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return EXPANSION * int(str(stats.sizeInBytes()))


def may_have_hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> bool:
    """Whether some key can have more than ``hot_rows`` rows, NULL included.

    Rows are counted by shares of the hash range, so what is shuffled does not grow with them.
    """
    share = F.pmod(F.xxhash64(*keys), F.lit(SHARES)).alias("_share")
    return not rows.groupBy(share).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows).isEmpty()


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    how: str = "left",
    residual: Column | None = None,
    hot_from: DataFrame | None = None,
    broadcast_bytes: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Join ``left`` to ``right`` on equal keys, plus an optional residual condition.

    ``on`` maps left key names to right key names. The right keys are not in the result,
    and the other column names of the two sides must differ.

    A right side known to be small is broadcast. Otherwise both sides are shuffled, and a
    key with more than ``hot_rows`` rows on the left is spread over as many salts as it
    takes to get back to that size; only the right rows of such keys are repeated. Rows
    with a NULL key match nothing and are spread as well. ``hot_from`` names a cheaper
    frame to count the keys on, such as the stored table ``left`` was derived from. If that
    rules hot keys out, the join is a plain one, which follows a layout of ``left`` by the keys.
    """
    if how not in LOOKUP_KINDS:
        raise ValueError(f"a lookup is one of {LOOKUP_KINDS}, not {how}: others would repeat right rows per salt")
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    many = HOT_ROWS if hot_rows is None else hot_rows
    right = right.withColumnsRenamed({r: f"_right_{l}" for l, r in pairs.items()})
    inner_names = [f"_right_{l}" for l in pairs]
    conditions = [F.col(l) == F.col(f"_right_{l}") for l in pairs]
    if residual is not None:
        conditions.append(residual)

    if planned_bytes(right) <= limit:
        return left.join(F.broadcast(right), _all(conditions), how).drop(*inner_names)
    if hot_from is not None and not may_have_hot_keys(hot_from, [*pairs], many):
        return left.join(right, _all(conditions), how).drop(*inner_names)

    # at most rows / hot_rows keys, so this side is small by construction
    hot = F.broadcast(
        (left if hot_from is None else hot_from)
        .groupBy(*pairs)
        .agg(F.ceil(F.count("*") / many).alias("_salts"))
        .where(F.col("_salts") > 1)
        .select(*[F.col(l).alias(f"_hot_{l}") for l in pairs], "_salts")
    )
    hot_names = [f"_hot_{l}" for l in pairs]
    no_key = reduce(lambda a, b: a | b, [F.col(l).isNull() for l in pairs])
    row = F.xxhash64(*[F.col(c) for c in left.columns])
    salts = F.when(no_key, NULL_KEY_SALTS).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = (
        left.join(hot, _all([F.col(l) == F.col(f"_hot_{l}") for l in pairs]), "left")
        .withColumn("_salt", F.pmod(row, salts))
        .drop(*hot_names, "_salts")
    )
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = (
        right.join(hot, _all([F.col(f"_right_{l}") == F.col(f"_hot_{l}") for l in pairs]), "left")
        .withColumn("_right_salt", F.explode(every_salt))
        .drop(*hot_names, "_salts")
    )
    met = _all([*conditions, F.col("_salt") == F.col("_right_salt")])
    return salted.join(repeated, met, how).drop(*inner_names, "_salt", "_right_salt")


def orphans(
    child: DataFrame, parent: DataFrame, on: Mapping[str, str] | Sequence[str], **options
) -> DataFrame:
    """Rows of ``child`` without a parent. A NULL key has no parent."""
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    known = parent.select(*pairs.values()).distinct()
    return lookup(child, known, pairs, how="left_anti", **options)


def orphan_count(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Number of orphan rows, as one row. Rows are counted per key before the shuffle."""
    known = parent.select(F.col(parent_key or key).alias("_known")).distinct()
    per_key = child.groupBy(key).agg(F.count("*").alias("_n"))
    loose = per_key.join(known, F.col(key) == F.col("_known"), "left_anti")
    return loose.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_count"))


def mark_known(
    child: DataFrame, parent: DataFrame, on: Mapping[str, str] | Sequence[str], name: str, **options
) -> DataFrame:
    """Add a boolean column telling whether the row has a parent."""
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    known = parent.select(*pairs.values()).distinct().withColumn("_known", F.lit(True))
    found = lookup(child, known, pairs, **options)
    return found.withColumn(name, F.col("_known").isNotNull()).drop("_known")


def full_compare(
    source: DataFrame, report: DataFrame, key: str, measures: Sequence[str]
) -> DataFrame:
    """Full outer join of two grouped frames; a measure missing on one side counts as 0.

    NULL keys do not pair, so each side keeps a row of its own.
    """
    s = source.select(F.col(key).alias("_s"), *[F.col(m).alias(f"source_{m}") for m in measures])
    r = report.select(F.col(key).alias("_r"), *[F.col(m).alias(f"report_{m}") for m in measures])
    both = s.join(r, F.col("_s") == F.col("_r"), "full_outer")
    filled = [
        F.coalesce(F.col(f"{side}_{m}"), F.lit(0)).alias(f"{side}_{m}")
        for m in measures
        for side in ("source", "report")
    ]
    return both.select(F.coalesce("_s", "_r").alias(key), *filled)


def remap_from(df: DataFrame, column: str, renames: DataFrame) -> DataFrame:
    """Replace values of ``column`` by a table ``(old_value, new_value)``."""
    found = lookup(df, renames.select("old_value", "new_value"), {column: "old_value"})
    return found.withColumn(column, F.coalesce("new_value", column)).drop("new_value")
