"""Key checks that grow with the loads (Q1, Q2).

Each load of a table leaves a summary, its rows counted per key.  A new load is
checked by its own keys: against the summaries of earlier loads for repeats, and
against the parent's for keys that refer to nothing.  Rows of earlier loads are
never read again.  Summaries and findings grow by runs that are published once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.filters import present
from lakemart.scratch import scratch_path
from lakemart.sources.appends import append_run, published
from lakemart.sources.paths import path_exists
from lakemart.sources.readers import read_runs


def _stored(frame: DataFrame) -> DataFrame:
    path = scratch_path(frame.sparkSession, "keys")
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return read_runs(spark, path) if path_exists(spark, path) else like.filter("false")


class KeyStore:
    """Summaries and findings of one key of a table, below ``path``.

    ``keys`` are the columns; ``parent``, for a foreign key, is the store of the
    parent's primary key, whose columns correspond in order.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], parent: KeyStore | None = None) -> None:
        self.spark, self.path, self.keys, self.parent = spark, path.rstrip("/"), list(keys), parent

    def summary(self) -> DataFrame:
        """Rows per key and load, of all loads."""
        return read_runs(self.spark, f"{self.path}/summary")

    def _count(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_rows"))

    def add(self, rows: DataFrame, run: str) -> int:
        """Checks a load and keeps its summary; the number of its violating keys, 0 for a load that was added before."""
        if published(self.spark, f"{self.path}/summary", run):
            return 0
        new = _stored(self._count(rows))
        found = append_run(self._repeated(new) if self.parent is None else self._orphans(new), f"{self.path}/found", run)
        append_run(new, f"{self.path}/summary", run)
        return found

    def _repeated(self, new: DataFrame) -> DataFrame:
        """Keys of this load that are null or, with earlier loads, occur more than once."""
        old = _read(self.spark, f"{self.path}/summary", new).filter(present(*self.keys))
        named = new.select(*self.keys).filter(present(*self.keys))
        again = old.join(named, self.keys, "left_semi")
        counted = new.unionByName(again).groupBy(*self.keys).agg(F.sum("n_rows").alias("n_rows"))
        return counted.filter((F.col("n_rows") > 1) | ~present(*self.keys))

    def _orphans(self, new: DataFrame) -> DataFrame:
        """Keys of this load without a parent so far."""
        parents = self.parent.summary().select(*[F.col(p).alias(k) for k, p in zip(self.keys, self.parent.keys, strict=True)]).distinct()
        return new.filter(present(*self.keys)).join(parents, self.keys, "left_anti")

    def violations(self) -> DataFrame:
        """Violating keys with their rows over all loads, as a check of all rows would find them."""
        found = read_runs(self.spark, f"{self.path}/found")
        if self.parent is None:
            # A later load counts the earlier ones in; null keys are counted per load.
            whole = present(*self.keys)
            total = F.when(F.first(whole), F.max("n_rows")).otherwise(F.sum("n_rows"))
            return found.groupBy(*self.keys).agg(total.alias("n_rows"))
        return self._orphans(found.groupBy(*self.keys).agg(F.sum("n_rows").alias("n_rows")))
