"""Layer paths, file listings and scratch space."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakemart.scratch import scratch_path

__all__ = ["Lake", "list_files", "list_tables", "path_exists", "qualified", "scratch_path"]


@dataclass(frozen=True)
class Lake:
    """``<base>/<layer>/<schema>/<table>.parquet`` for every layer below ``base``."""

    base: str
    schema: str = "market"

    def path(self, layer: str, table: str) -> str:
        """Table path; a leading ``<layer>_`` of the table name is dropped."""
        return f"{self.layer(layer)}/{table.removeprefix(f'{layer}_')}.parquet"

    def layer(self, layer: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{self.schema}"

    @property
    def bronze(self) -> str:
        return self.layer("bronze")


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """The path as file listings show it, with scheme and without a trailing slash."""
    files, hadoop_path = _hadoop(spark, path)
    return files.makeQualified(hadoop_path).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _hadoop(spark, path)
    return files.exists(hadoop_path)


def list_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Table name to path for each directory below ``root``, empty when there is no root.

    A metadata call over one directory level; no data is read.
    """
    files, hadoop_path = _hadoop(spark, root)
    if not files.exists(hadoop_path):
        return {}
    names = [s.getPath().getName() for s in files.listStatus(hadoop_path) if s.isDirectory()]
    return {
        name.removesuffix(".parquet"): f"{root.rstrip('/')}/{name}"
        for name in sorted(names)
        if not name.startswith(("_", "."))
    }


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path and size of every file below ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    )
