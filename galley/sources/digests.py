"""Digests of content that can be added up.

A row's text (its columns by name, each with the length of its value; NULLs and lineage
left out) has a SHA-256; a digest is the number of rows and the sum of these hashes modulo
2^256, in eight sums of 32 bits each. So the digest of two sets of rows is the sum of both,
whatever the order of rows: a load's digest is kept beside it, and the fingerprint of a
table of many loads reads only loads that have none yet. A changed value and a repeated row
both change it; a column that is NULL throughout does not.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from galley.sources.store import TableStore

LIMBS = [f"limb{k}" for k in range(8)]
LIMBS_DDL = ", ".join(f"{limb} decimal(38,0)" for limb in LIMBS)
_KEPT = f"leaf string, n bigint, {LIMBS_DDL}"


def row_text(columns: list[str]) -> Column:
    def part(c: str) -> Column:
        value = F.col(f"`{c}`").cast("string")  # costs nothing where it is text already
        named = F.concat(F.lit(f"{c}="), F.length(value).cast("string"), F.lit(":"), value, F.lit(";"))
        return F.coalesce(named, F.lit(""))

    return F.concat(F.lit(""), *[part(c) for c in sorted(columns) if not c.startswith("_")])


def content_digest(df: DataFrame, *by: str) -> DataFrame:
    """``n`` and the sums ``limb0`` to ``limb7``, as one row, or one for each value of ``by``."""
    content = [c for c in df.columns if c not in by and not c.startswith("_")]
    # text is used twice, by length and value, and made once
    texts = df.select(*by, *[F.col(f"`{c}`").cast("string").alias(c) for c in content])
    hashed = texts.select(*by, F.sha2(row_text(content), 256).alias("h"), F.spark_partition_id().alias("_task"))

    def limb(k: int) -> Column:
        return F.conv(F.substring("h", 8 * k + 1, 8), 16, 10).cast("bigint")

    # a task has fewer than 2^31 rows, so its sums are whole numbers of 64 bits; those of tasks are added as decimals
    tasks = hashed.groupBy(*by, "_task").agg(F.count("*").alias("n"), *[F.sum(limb(k)).alias(name) for k, name in enumerate(LIMBS)])
    sums = [F.coalesce(F.sum(F.col(c).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(c) for c in LIMBS]
    return tasks.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *sums)


def added(digests: DataFrame) -> DataFrame:
    """The digest of all rows of several digests."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)").alias(c) for c in LIMBS]
    return digests.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *sums)


def fingerprint(digest: Row) -> str:
    """SHA-256 of a digest's number of rows and sum."""
    total = sum(int(digest[limb]) << (32 * (7 - k)) for k, limb in enumerate(LIMBS)) % (1 << 256)
    return hashlib.sha256(f"{digest['n']}:{total:064x}".encode()).hexdigest()


def load_digests(store: TableStore, entity: str) -> tuple[DataFrame, list[str]]:
    """Digests of the loads of an entity, one row each, and the loads read to get them.

    A load that is written again has another version, and so another digest.
    """
    kept = store.latest("typed", f"{entity}_digests")
    if kept is None:
        kept = store.spark.createDataFrame([], _KEPT)
    leaves = store.load_leaves(entity)  # names of folders
    known = {r["leaf"] for r in kept.select("leaf").collect()}
    fresh = [leaf for leaf in leaves if leaf not in known]
    table = kept.where(F.col("leaf").isin(leaves)) if leaves else kept.limit(0)
    for leaf in fresh:
        table = table.unionByName(content_digest(store.spark.read.parquet(leaf)).withColumn("leaf", F.lit(leaf)))
    if fresh:
        table = store.advance("typed", f"{entity}_digests", table.coalesce(1))
    return table, fresh


def loads_fingerprint(store: TableStore, entity: str) -> str:
    return fingerprint(added(load_digests(store, entity)[0]).first())
