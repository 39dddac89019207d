"""Tables that grow by runs, each run published whole and once.

A run writes into a staging folder of its own and then renames it to
``run=<id>``; the rename does not replace, so of two runs with one id the first
wins and the other's rows are dropped.  A run that broke off leaves a staging
folder, which scans skip.  The rename is atomic on HDFS and on local and mounted
folders; a store without renames needs a table format instead.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors.exceptions.captured import CapturedException
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from lakemart.sources.paths import path_exists
from lakemart.sources.writers import write_as

INITIAL = "initial"


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a folder unless the target exists; then it is removed."""
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(new):
        files.mkdirs(new.getParent())
        context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        try:
            context.rename(files.makeQualified(old), files.makeQualified(new), options)
            return True
        except (CapturedException, Py4JJavaError):
            if not files.exists(new):
                raise
    files.delete(old, True)
    return False


def published(spark: SparkSession, path: str, run: str) -> bool:
    return path_exists(spark, f"{path}/run={run}")


def run_folders(spark: SparkSession, path: str) -> list[str] | None:
    """Names of the published runs; None where the folder holds files that belong to none."""
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [s.getPath().getName() for s in found if not s.getPath().getName().startswith(("_", "."))]
    return [n.removeprefix("run=") for n in names] if all(n.startswith("run=") for n in names) else None


def append_run(df: DataFrame, path: str, run: str, format_: str = "parquet") -> int:
    """Adds the rows as run ``run``; the rows added, 0 where the run is there already."""
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"a run is named by letters, digits, '.', '_' and '-', not {run!r}")
    spark = df.sparkSession
    if published(spark, path, run):
        return 0
    staging = f"{path}/_staging/{run}-{uuid.uuid4().hex}"
    rows = write_as(df, staging, format_)
    return rows if _renamed(spark, staging, f"{path}/run={run}") else 0


def create_once(df: DataFrame, path: str, format_: str = "parquet") -> bool:
    """Creates the table with these rows as its first run, unless there is one; whether it did.

    The whole folder appears by one rename, so nobody sees half of it and one of
    several initialisations wins.
    """
    spark = df.sparkSession
    if path_exists(spark, path):
        return False
    folder, _, name = path.rstrip("/").rpartition("/")
    staging = f"{folder}/_{name}-{uuid.uuid4().hex}"
    write_as(df, f"{staging}/run={INITIAL}", format_)
    return _renamed(spark, staging, path.rstrip("/"))
