"""Scans (S1-S6, S11, K9)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.cleaning import epoch_to_timestamp, whole_number
from lakemart.schemas import CORRUPT, CRAWLED_AT
from lakemart.sources.appends import create_once
from lakemart.sources.datasets import Dataset, dataset
from lakemart.sources.paths import Lake, path_exists

SOURCE_PATH = "source_path"
#: When a document was crawled: as it says itself, else when its file was last changed.
CRAWL_TIME = "crawl_time"
PROVENANCE = (CRAWL_TIME, SOURCE_PATH)
#: Text of a refused document.
REFUSED = "_refused"
#: Folder of NULL, as the writer names it.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header that must name the columns of ``schema`` (S1); quotes are doubled, not escaped.

    Empty text is missing: the format does not tell the two apart.

    ``multi_line`` allows line breaks inside quoted fields, at the price that a file is no longer split.
    """
    return (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, quote='"', escape='"', multiLine=multi_line, recursiveFileLookup=True)
        .csv(path)
    )


def _folder_value(name: str) -> Column:
    """Value of a partition folder in the path; escapes are undone twice, the path's and the folder's."""
    found = F.regexp_extract(SOURCE_PATH, f"/{re.escape(name)}=([^/]*)/", 1)
    plain = found
    for _ in range(2):
        plain = F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))
    return F.when(~found.isin("", _NULL_FOLDER), plain)


def read_json(
    spark: SparkSession,
    path: str,
    schema: str,
    files: str = "*",
    one_per_file: bool = False,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """JSON below ``path`` with ``_corrupt_record`` and ``source_path``.

    Partition folders are columns only where ``partition_by`` names them, as
    text; a column that the schema has too keeps its own values first.
    """
    documents = (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .options(
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=CORRUPT,
            multiLine=one_per_file,
            recursiveFileLookup=True,
            pathGlobFilter=files,
        )
        .json(path)
        .withColumn(SOURCE_PATH, F.col("_metadata.file_path"))
    )
    for name in partition_by:
        value = _folder_value(name)
        if name in documents.columns:
            value = F.coalesce(F.col(name), value.cast(documents.schema[name].dataType))
        documents = documents.withColumn(name, value)
    return documents


#: A row of a table of compacted documents.
COMPACTED = "path string, size bigint, modified timestamp, text string"


def _no_documents(spark: SparkSession, source: Dataset) -> DataFrame:
    return spark.createDataFrame([], f"{source.schema}, {CORRUPT} string, {SOURCE_PATH} string, {CRAWL_TIME} timestamp")


def read_documents(spark: SparkSession, root: str, name: str, layout: str = "document") -> DataFrame:
    """All documents of a dataset below ``root``.

    ``layout="document"`` reads one document per file, chosen by file name.
    ``layout="lines"`` reads ``<root>/<dataset>`` with one document per line,
    which splits large files over many tasks.  No such folder gives no rows.
    """
    source: Dataset = dataset(name)
    if layout not in ("document", "lines"):
        raise ValueError(f"layout must be 'document' or 'lines', not {layout!r}")
    per_file = layout == "document"
    path = root if per_file else f"{root.rstrip('/')}/{name}"
    if not path_exists(spark, path):
        return _no_documents(spark, source)
    documents = read_json(spark, path, source.schema, source.files if per_file else "*", per_file)
    return documents.withColumn(CRAWL_TIME, crawl_time(F.col("_metadata.file_modification_time")))


def crawl_time(otherwise: Column | None = None) -> Column:
    """Crawl time of a document from its own field, in seconds, or ``otherwise`` where it has none."""
    seconds = epoch_to_timestamp(whole_number(F.col(CRAWLED_AT)))
    return seconds if otherwise is None else F.coalesce(seconds, otherwise)


def read_compacted(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All documents of a dataset as compaction stored them, a row with path, time and text per file."""
    source: Dataset = dataset(name)
    if not path_exists(spark, path):
        return _no_documents(spark, source)
    schema = f"{source.schema}, {CORRUPT} string"
    stored = read_runs(spark, path, COMPACTED)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # Text without any value parses to NULL, and is refused like other text that is no object.
    nothing = F.from_json(F.lit("{}"), schema, options)
    parsed = stored.withColumn("_document", F.coalesce(F.from_json("text", schema, options), nothing))
    corrupt = F.when(F.trim(F.regexp_replace("text", r"\s+", " ")).isin("", "null"), F.col("text")).otherwise(F.col(f"_document.{CORRUPT}"))
    fields = [F.col(f"_document.`{f.name}`") for f in spark.createDataFrame([], source.schema).schema.fields]
    rows = parsed.select(*fields, corrupt.alias(CORRUPT), F.col("path").alias(SOURCE_PATH), "modified")
    return rows.withColumn(CRAWL_TIME, crawl_time(F.col("modified"))).drop("modified")


def read_runs(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of all runs of a Parquet table that grows by runs; the run is no column."""
    reader = spark.read.option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema else reader).parquet(path)


def is_reject(documents: DataFrame) -> Column:
    """Whether a scanned row is no JSON object.

    A document that is one but has a field of an unexpected shape keeps its
    other fields; its text is parsed a second time to tell, and only its.  The
    test names every field: a scan that asks for a few checks only those, and a
    document bad elsewhere would count as good or not by what the caller
    happens to select.
    """
    fields = [c for c in documents.columns if c not in (CORRUPT, *PROVENANCE)]
    every_field = F.to_json(F.struct(*fields))
    return F.col(CORRUPT).isNotNull() & F.json_object_keys(F.col(CORRUPT)).isNull() & every_field.isNotNull()


def split_rejects(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable documents, and path plus text of the others (S3)."""
    rejected = is_reject(documents)
    good = documents.filter(~rejected).drop(CORRUPT)
    return good, documents.filter(rejected).select(SOURCE_PATH, F.col(CORRUPT).alias("raw"))


def carry_rejects(documents: DataFrame, name: str) -> DataFrame:
    """All documents, ``REFUSED`` in place of the corrupt record; those refused are blank otherwise.

    A blank document flattens to one row, so that one pass over the documents
    gives the flat rows and, carried along, the text of the rejects.
    """
    source: Dataset = dataset(name)
    blank = F.from_json(F.lit(source.blank), source.schema)
    refused = F.col(REFUSED).isNotNull()
    kept = {c: F.when(refused, blank[c]).otherwise(F.col(c)) for c in documents.columns if c not in (CORRUPT, REFUSED, *PROVENANCE)}
    return documents.withColumns(kept).drop(CORRUPT)


def with_refused(documents: DataFrame) -> DataFrame:
    """``documents`` with the text of those that are no JSON object as ``REFUSED``, NULL for the others."""
    return documents.withColumn(REFUSED, F.when(is_reject(documents), F.col(CORRUPT)))


def read_required(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet input that must exist: ``None`` when empty, ``ValueError`` when missing or unreadable."""
    try:
        df = spark.read.parquet(path)
        return None if df.isEmpty() else df
    except (PySparkException, Py4JError) as error:
        raise ValueError(f"cannot read required input {path}") from error


def read_upstream(spark: SparkSession, path: str | None, default_path: str) -> DataFrame:
    """Parquet output of an earlier job, at its usual path unless told otherwise."""
    return spark.read.parquet(path or default_path)


def read_layer(spark: SparkSession, lake: Lake, layer: str, table: str) -> DataFrame:
    """Parquet table on the layer path."""
    return spark.read.parquet(lake.path(layer, table))


def open_or_init(spark: SparkSession, path: str, schema: str, initial: DataFrame | None = None) -> DataFrame:
    """A stored CSV; when absent it is first written from ``initial``, or with the header only.

    It appears whole, by one rename: of several jobs that find none one wins,
    and all read what it wrote.  Line breaks inside quoted fields are read back,
    since the sink writes them; runs that were added later are read too.
    """
    create_once(spark.createDataFrame([], schema) if initial is None else initial, path, "csv")
    return read_csv(spark, path, schema, multi_line=True)


_READERS = {
    "csv": lambda spark, path, schema: read_csv(spark, path, schema),
    "json": lambda spark, path, schema: read_json(spark, path, schema),
    "parquet": lambda spark, path, schema: spark.read.parquet(path),
}


def read_as(spark: SparkSession, path: str, format_: str, schema: str | None = None) -> DataFrame:
    """Read one of the known formats; any other is an error (K9)."""
    if format_ not in _READERS:
        raise ValueError(f"unsupported format {format_!r}, expected one of {sorted(_READERS)}")
    if schema is None and format_ != "parquet":
        raise ValueError(f"reading {format_} needs a schema")
    return _READERS[format_](spark, path, schema)
