"""Run a registered query and its oracle and compare the rows, whatever their order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):  # exactly, whatever their scales
        return f"{decimal.Decimal(value).normalize():f}"
    if isinstance(value, float):  # sums of doubles depend on their order in the last digits
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, dict):
        return tuple(sorted((str(k), _plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def differences(con: duckdb.DuckDBPyConnection, df: DataFrame, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns: {sorted(df.columns)} against {sorted(names)}"
    order = sorted(names)
    want = Counter(tuple(_plain(r[names.index(c)]) for c in order) for r in expected)
    got = Counter(tuple(_plain(r[c]) for c in order) for r in df.collect())
    if want == got:
        return None
    missing, extra = list((want - got).items()), list((got - want).items())
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; columns {order}\n"
        f"  only in oracle ({len(missing)}): {missing[:3]}\n  only in Spark ({len(extra)}): {extra[:3]}"
    )
