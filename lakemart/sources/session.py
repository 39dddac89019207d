"""Session settings (S10).  Jobs take a session from the caller; only scripts and tests build one."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def session_conf() -> dict[str, str]:
    """Settings the jobs are designed for: adaptive plans with skew splitting, UTC, proleptic calendar in files."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
        "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
        "spark.sql.sources.partitionOverwriteMode": "static",
    }


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs over wide rows run in methods that the JVM compiles; the session's setting comes back after them.

    The JVM interprets a method of more than 8000 bytes of code for ever, and by
    default Spark makes one of every column of a document.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def object_store_conf(endpoint: str, access_key: str, secret_key: str, path_style: bool = True) -> dict[str, str]:
    """S3-compatible store behind ``s3a://`` paths."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def build_session(app_name: str, master: str | None = None, conf: Mapping[str, str] | None = None) -> SparkSession:
    """Session with :func:`session_conf` and any further settings; ``master`` is left to the submitter by default."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**session_conf(), **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
