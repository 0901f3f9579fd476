"""Keyed upsert into a table snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    updates: Sequence[str],
    version: str | None = None,
) -> DataFrame:
    """New snapshot of ``target``: known keys take ``updates``, new keys all columns.

    ``changes`` has one row per key; rows without a key are left out. With ``version``, a
    known row is only updated by one that is not older, so replays are harmless.
    """
    columns = target.columns
    incoming = changes.where(F.col(key).isNotNull()).select(
        *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    met = target.join(incoming, F.col(key) == F.col(f"_new_{key}"), "full_outer")
    takes = F.col(f"_new_{key}").isNotNull()
    if version:
        older = F.coalesce(F.col(f"_new_{version}") < F.col(version), F.lit(False))
        takes = takes & ~older
    result = []
    for c in columns:
        known = F.when(takes, F.col(f"_new_{c}")).otherwise(F.col(c)) if c in updates else F.col(c)
        result.append(F.when(F.col(key).isNull(), F.col(f"_new_{c}")).otherwise(known).alias(c))
    return met.select(*result)
