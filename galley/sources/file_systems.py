"""Hadoop addresses for tasks that stream bytes by themselves.

Spark names files by Hadoop schemes and reads their settings from its configuration; Arrow
knows other names for both. The one place where the former become the latter.
"""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark import cloudpickle
from pyspark.sql import SparkSession

#: Settings of S3 that are handed on (fixed names of Hadoop).
S3_SETTINGS = (
    "fs.s3a.access.key",
    "fs.s3a.secret.key",
    "fs.s3a.session.token",
    "fs.s3a.endpoint",
    "fs.s3a.endpoint.region",
    "fs.s3a.connection.ssl.enabled",
    "fs.s3a.path.style.access",
)


def settings_of(spark: SparkSession) -> dict[str, str]:
    """The settings of the session that tasks need to open files."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    found = {name: conf.get(name) for name in S3_SETTINGS}
    return {name: value for name, value in found.items() if value}


def s3_arguments(settings: dict[str, str]) -> dict:
    """Arguments of Arrow's S3 file system; without keys it looks for credentials itself."""
    endpoint = settings.get("fs.s3a.endpoint", "")
    scheme, _, host = endpoint.rpartition("://")
    arguments = {
        "access_key": settings.get("fs.s3a.access.key"),
        "secret_key": settings.get("fs.s3a.secret.key"),
        "session_token": settings.get("fs.s3a.session.token"),
        "region": settings.get("fs.s3a.endpoint.region"),
        "endpoint_override": host or None,
        "scheme": scheme or ("http" if settings.get("fs.s3a.connection.ssl.enabled") == "false" else None),
    }
    if host:  # other stores than the one Amazon runs
        arguments["force_virtual_addressing"] = settings.get("fs.s3a.path.style.access") != "true" and "amazonaws" in host
    return {name: value for name, value in arguments.items() if value is not None}


def opened(uri: str, settings: dict[str, str]):
    """Arrow's file system of a Hadoop address, and the path on it."""
    from pyarrow import fs

    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if "%" in parts.path else parts.path
    if parts.scheme in ("s3a", "s3n", "s3"):
        return fs.S3FileSystem(**s3_arguments(settings)), f"{parts.netloc}{unquote(parts.path)}"
    if parts.scheme in ("hdfs", "viewfs"):
        return fs.HadoopFileSystem.from_uri(f"{parts.scheme}://{parts.netloc}/"), unquote(parts.path)
    return fs.FileSystem.from_uri(uri)


def has_folders(system) -> bool:
    """Whether folders have to be made before files in them."""
    return system.type_name not in ("s3", "gcs")


cloudpickle.register_pickle_by_value(__import__("sys").modules[__name__])
