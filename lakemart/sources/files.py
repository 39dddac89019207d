"""Files that tasks list, read and write themselves.

One document per file means very many small files.  Their names are never
listed on the driver: folders are a table, whose tasks list one folder each and
return files and further folders, level by level.  Reading and writing go by a
table of paths.  Tasks reach the files through ``pyarrow.fs``: local or mounted
folders, ``hdfs://``, ``s3://`` (``s3a://`` is read as such) and ``gs://``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.scratch import scratch_path

#: Bytes and files that a task reads, and bytes that it hands on at a time.
TASK_BYTES, TASK_FILES = 64 << 20, 2000
_BATCH_BYTES = 8 << 20
_LISTING = "path string, size bigint, modified timestamp"


def _open(path: str):
    """File system of a path, the path inside it, and what stands before that."""
    from pyarrow import fs

    plain = re.match(r"(?:file:(?://)?)?(/.*)", path)
    if plain:
        return fs.LocalFileSystem(), plain[1], path[: len(path) - len(plain[1])]
    scheme, authority, rest = re.fullmatch(r"(\w+)://([^/]*)(.*)", path).groups()
    files, base = fs.FileSystem.from_uri(f"{re.sub('^s3[an]$', 's3', scheme)}://{authority}/")
    base = base.rstrip("/")
    return files, base + rest, path[: len(path) - len(rest) - (len(authority) if base else 0)]


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Direct entries of every folder; a folder has no size."""
    from pyarrow import fs

    for batch in batches:
        for folder in batch.column("path").to_pylist():
            files, inner, prefix = _open(folder)
            found = files.get_file_info(fs.FileSelector(inner, allow_not_found=True))
            found = [f for f in found if not f.base_name.startswith(("_", "."))]
            for start in range(0, len(found), 10_000):
                part = found[start : start + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([prefix + f.path for f in part], pa.string()),
                        pa.array([f.size if f.type == fs.FileType.File else None for f in part], pa.int64()),
                        pa.array([f.mtime for f in part], pa.timestamp("us", "UTC")),
                    ],
                    names=["path", "size", "modified"],
                )


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """``path, size, modified`` of every file below ``root``, none where there is no such folder.

    A job per level of folders, a row per folder; names that begin with ``_``
    or ``.`` are left out, as scans do.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders = spark.createDataFrame([(root.rstrip("/"),)], "path string")
    levels = []
    while True:
        path = scratch_path(spark, "listing")
        folders.repartition(tasks).mapInArrow(_entries, _LISTING).write.parquet(path)
        found = spark.read.parquet(path)
        levels.append(found.filter("size IS NOT NULL"))
        folders = found.filter("size IS NULL").select("path")
        if folders.isEmpty():
            return reduce(DataFrame.unionAll, levels)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        start, texts, size = 0, [], 0
        for place, path in enumerate(batch.column("path").to_pylist(), 1):
            files, inner, _ = _open(path)
            with files.open_input_stream(inner) as stream:
                content = stream.read()
            texts.append(content.decode("utf-8", "replace"))
            size += len(content)
            if size >= _BATCH_BYTES or place == batch.num_rows:
                rows = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])
                start, texts, size = place, [], 0


def read_files(entries: DataFrame) -> DataFrame:
    """``path, size, modified`` of stored ``entries`` with ``text``, the whole file; tasks get about ``TASK_BYTES`` or ``TASK_FILES`` each."""
    total, n_files = entries.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(1, -(-total // TASK_BYTES), -(-n_files // TASK_FILES))
    return entries.select("path", "size", "modified").repartition(tasks).mapInArrow(_contents, f"{_LISTING}, text string")


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist(), strict=True):
            files, inner, _ = _open(path)
            folder, _, name = inner.rpartition("/")
            files.create_dir(folder)
            part = f"{folder}/_{name}.{uuid.uuid4().hex}"
            with files.open_output_stream(part) as stream:
                stream.write(text.encode("utf-8"))
            files.move(part, inner)
        yield pa.RecordBatch.from_arrays([batch.column("path")], names=["path"])


def write_files(rows: DataFrame, root: str) -> int:
    """One file per row, ``text`` under ``root`` and the row's relative ``path`` (K6); the number of files.

    Each appears under its name when it is whole; a task that runs again
    replaces its files by the same.
    """
    named = rows.select(F.concat(F.lit(f"{root.rstrip('/')}/"), "path").alias("path"), "text")
    return named.mapInArrow(_written, "path string").count()
