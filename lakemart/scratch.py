"""Scratch space for intermediate tables, and shuffle files behind them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables.

    Below the shared folder named by ``spark.checkpoint.dir``, so every
    executor sees it and losing one loses nothing; a temporary folder only
    where a local session names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor reaches")
        shared = tempfile.mkdtemp(prefix="lakemart-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends, not some time later; the session's setting comes back after."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
