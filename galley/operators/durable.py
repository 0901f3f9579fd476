"""Intermediate results that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="galley-")
    context.setCheckpointDir(folder)
    return folder


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back.

    Values that depend on how rows fell into partitions stay what they were, however
    often later stages read them or are retried.
    """
    spark = df.sparkSession
    return _written(df, f"{shared_folder(spark)}/pinned/{spark.sparkContext.applicationId}")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A ``pin`` for jobs that write their results before the block ends: then its folders go."""
    folder = f"{shared_folder(spark)}/scratch/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    try:
        yield lambda df: _written(df, folder)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _written(df: DataFrame, folder: str) -> DataFrame:
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
