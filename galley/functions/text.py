"""Strings, keys and fingerprints."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_any(*parts: Column) -> Column:
    """Concatenate and skip NULL parts."""
    return F.concat_ws("", *parts)


def join_all(*parts: Column) -> Column:
    """Concatenate; NULL as soon as one part is NULL."""
    return F.concat(*parts)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def fingerprint(*attributes: Column) -> Column:
    """md5 over the attributes joined with ``|``; NULL attributes are skipped."""
    return F.md5(F.concat_ws("|", *attributes))


def json_field(document: Column, path: str, default: str | None = None) -> Column:
    """Text at a dot path of a JSON document, or ``default`` where it is absent."""
    found = F.get_json_object(document, f"$.{path}")
    return found if default is None else F.coalesce(found, F.lit(default))


def remap(value: Column, renames: Mapping[str, str]) -> Column:
    """Replace the values listed in ``renames``, keep all others.

    The list is a literal in the plan, so it is meant for hand-kept lists. Rename lists
    that live in a table go through ``operators.joins.remap_from``.
    """
    if not renames:
        return value
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(renames.items())])
    return F.coalesce(F.try_element_at(table, value), value)
