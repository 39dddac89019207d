"""The document layout, one document per file, through a manifest and compaction.

``documents/<schema>/manifest.parquet`` lists every file below bronze, with the
dataset that its name belongs to; ``documents/<schema>/<dataset>.parquet`` holds
the files' text, path and time.  Both grow by runs.  A file that is new, or was
changed, is one more row of both; the silver jobs choose between crawls.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.paths import basename
from lakemart.operators.keys import keep_new
from lakemart.scratch import scratch_path
from lakemart.sources.appends import append_run
from lakemart.sources.datasets import DATASETS, dataset
from lakemart.sources.files import list_tree, read_files
from lakemart.sources.paths import Lake, path_exists, qualified
from lakemart.sources.readers import COMPACTED, read_runs

LAYER = "documents"
_FILE = ["path", "size", "modified"]
_MANIFEST = "path string, name string, size bigint, modified timestamp, dataset string"


def dataset_of(name: Column) -> Column:
    """Dataset that a file name belongs to, NULL for other files."""
    found = F.lit(None).cast("string")
    for source in DATASETS.values():
        pattern = "^" + re.escape(source.files).replace(r"\*", ".*") + "$"
        found = F.when(name.rlike(pattern), F.lit(source.name)).otherwise(found)
    return found


def manifest(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every file that was ever listed."""
    path = lake.path(LAYER, "manifest")
    return read_runs(spark, path, _MANIFEST) if path_exists(spark, path) else spark.createDataFrame([], _MANIFEST)


def _run_name(run: str | None) -> str:
    return run or uuid.uuid4().hex


def update_manifest(spark: SparkSession, lake: Lake, run: str | None = None) -> int:
    """Lists bronze and adds the files that are new or were changed; their number.

    Folders are listed by tasks, and the files stay where they are.
    """
    listing = list_tree(spark, qualified(spark, lake.bronze))
    name = basename(F.col("path"))
    found = listing.select("path", name.alias("name"), "size", "modified").withColumn("dataset", dataset_of(F.col("name")))
    return append_run(keep_new(found, manifest(spark, lake), _FILE), lake.path(LAYER, "manifest"), _run_name(run))


def compact(spark: SparkSession, lake: Lake, name: str, run: str | None = None) -> int:
    """Adds the text of every listed file of a dataset that has none yet; their number.

    What is missing is told by the stored rows themselves, so a run that broke
    off is made up for by the next.
    """
    path = lake.path(LAYER, dataset(name).name)
    entries = manifest(spark, lake).filter(F.col("dataset") == name).select(*_FILE).distinct()
    if path_exists(spark, path):
        entries = keep_new(entries, read_runs(spark, path, COMPACTED), _FILE)
    todo = scratch_path(spark, "to-compact")
    entries.write.parquet(todo)
    return append_run(read_files(spark.read.parquet(todo)), path, _run_name(run))
