"""All registered queries, with their oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, oracle: str | None = None) -> None:
    from checks.oracle_tables import with_tables

    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = query
    if oracle is not None:
        ORACLES[name] = with_tables(oracle)


def query(name: str, oracle: str | None = None):
    """Decorator form of ``register``."""

    def keep(function: Query) -> Query:
        register(name, function, oracle)
        return function

    return keep


def load_all() -> None:
    from checks import audit, business, feed, ingest, models, operators, refreshed  # noqa: F401
