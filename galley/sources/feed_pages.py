"""Pages of the delivery provider: landing, reading and flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.functions import parse_utc
from galley.sources.contracts import FEED_PAGE, FEED_TIMES


def land_pages(
    pages: DataFrame,
    root: str,
    provider: str,
    source: str,
    ingestion_date: str,
    request: str = "0",
    pages_per_file: int = 0,
) -> str:
    """Keep the response envelopes of a request as JSON under provider, source and ingestion date.

    Every request has a folder of its own, so landing one again replaces it. The files are
    compressed, and one is read by one task; ``pages_per_file`` bounds how much that is (0: no bound).
    """
    escape = pages.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parts = {"provider": provider, "source": source, "ingestion_date": ingestion_date, "request": request}
    leaf = "/".join(f"{name}={escape.escapePathName(value)}" for name, value in parts.items())
    writer = pages.write.mode("overwrite").option("ignoreNullFields", False).option("maxRecordsPerFile", pages_per_file)
    writer.json(f"{root}/{leaf}", compression="gzip")
    return root


def pages_glob(root: str, provider: str) -> str:
    return f"{root}/provider={provider}/*/*/*/*.json*"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEED_PAGE).json(path)


def flatten(pages: DataFrame, *kept: str) -> DataFrame:
    """One row per record, times as zone-less UTC, with columns of its page that are to be kept.

    Works on batches and streams alike.
    """
    records = pages.select(F.explode("data").alias("payload"), *kept).select("payload.*", *kept)
    return records.withColumns({c: parse_utc(F.col(c)) for c in FEED_TIMES})
