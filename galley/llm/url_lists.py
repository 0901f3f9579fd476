"""Dated URL lists: entries become validity intervals, captures meet those of their time.

A list's events add or remove a domain (and all below it) or an address prefix (at a path
boundary). Per entry the events in time order give intervals in which it is active. A
capture looks up its host, the domains above it and the prefixes of its path, as of the
time it was fetched: intervals are filed under every month they touch, captures under
their month, so the join is on equal keys and then on the interval, and a frequent host is
spread over its months.

Defined cases: an add and a remove at one time leave the entry inactive; intervals include
their first moment and not their last; events without time, list or value are no events;
captures without address, host or time match nothing; repeated captures get an answer each;
hosts are compared in lower case, without port, user and trailing dot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galley.llm.common import numbered, stored

ROW = "__llm_row"
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host, null where there is none."""
    host = F.lower(F.regexp_extract(url, AUTHORITY, 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", ""), r"\.$", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Path without slashes at its ends, query and fragment."""
    return F.regexp_replace(F.regexp_extract(url, PATH, 1), r"^/+|/+$", "")


def domains_of(host: Column) -> Column:
    """The host and the domains above it, at most as many as it has labels."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )


def prefixes_of(host: Column, path: Column) -> Column:
    """Host and path cut at every slash."""
    parts = F.split(path, "/")
    some = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"))
    )
    return F.when(path != "", some).otherwise(F.array().cast("array<string>"))


def intervals(events: DataFrame) -> DataFrame:
    """list, kind, value, since, until (null: still active) from list, kind, value, action, at."""
    known = events.filter(
        "list IS NOT NULL AND kind IN ('domain', 'prefix') AND value IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')"
    )
    states = known.groupBy("list", "kind", "value", "at").agg(F.min(F.col("action") == "add").alias("active"))
    entry = Window.partitionBy("list", "kind", "value").orderBy("at")
    changes = states.withColumn("was", F.lag("active").over(entry)).filter(
        F.col("active") != F.coalesce("was", F.lit(False))
    )
    return (
        changes.withColumn("until", F.lead("at").over(entry))
        .filter("active")
        .select("list", "kind", "value", F.col("at").alias("since"), "until")
    )


def month_of(at: Column) -> Column:
    return F.year(at) * 12 + F.month(at)


def evaluate(captures: DataFrame, events: DataFrame, keep: list[str], url: str = "url", fetched_at: str = "fetched_at") -> DataFrame:
    """The columns ``keep`` of every capture with n_entries and the lists that were against it."""
    rows = numbered(captures.select(*keep, F.col(f"`{url}`").alias("__llm_url"), F.col(f"`{fetched_at}`").alias("__llm_at")), ROW)
    rows = stored(rows, "captures")
    named = rows.withColumns({"__llm_host": host_of(F.col("__llm_url")), "__llm_path": path_of(F.col("__llm_url"))})
    looks = named.filter("__llm_host IS NOT NULL AND __llm_at IS NOT NULL").select(
        ROW,
        F.col("__llm_at").alias("at"),
        F.explode(
            F.concat(
                F.transform(domains_of(F.col("__llm_host")), lambda v: F.struct(F.lit("domain").alias("kind"), v.alias("value"))),
                F.transform(
                    prefixes_of(F.col("__llm_host"), F.col("__llm_path")),
                    lambda v: F.struct(F.lit("prefix").alias("kind"), v.alias("value")),
                ),
            )
        ).alias("look"),
    )
    looks = looks.select(ROW, "at", "look.*", month_of(F.col("at")).alias("month"))
    # open intervals end with the last capture's month: the calendar bounds the copies, not the data
    last = rows.agg(F.max(month_of(F.col("__llm_at"))).alias("m")).first()["m"] or 0
    active = stored(intervals(events), "url-intervals")
    end = F.least(F.coalesce(month_of(F.col("until")), F.lit(last)), F.lit(last))
    filed = active.filter(month_of(F.col("since")) <= end).withColumn(
        "month", F.explode(F.sequence(month_of(F.col("since")), end))
    )
    met = looks.join(filed, ["kind", "value", "month"]).filter("at >= since AND (until IS NULL OR at < until)")
    answers = met.groupBy(ROW).agg(F.count("*").alias("n_entries"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))
    return rows.join(answers, ROW, "left").select(
        *(F.col(f"`{c}`") for c in keep),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.coalesce("lists", F.lit("")).alias("lists"),
    )
