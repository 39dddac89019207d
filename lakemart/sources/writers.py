"""Sinks (K1, K2, K6-K9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemart.sources.paths import Lake


def _save(df: DataFrame, path: str, format_: str, mode: str, partition_by: Sequence[str], **options: object) -> int:
    """Write and count in one job.

    The count sits right above the write, in the result stage, where Spark
    counts each task once even if it ran again after a lost executor.
    """
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("n_rows")).write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(format_).save(path)
    return counted.get["n_rows"]


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), **options: object) -> int:
    """Parquet sink that returns the rows written (K1)."""
    return _save(df, path, "parquet", mode, partition_by, **options)


#: Documents of a compressed JSON file, which one task reads whole.
PACKED_DOCUMENTS = 100_000


def write_json(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), packed: bool = False) -> int:
    """JSON sink, one document per line, in folders by the given columns (K6); NULL fields are kept.

    ``packed`` compresses the files by gzip and ends each after ``PACKED_DOCUMENTS``, as scans do not split them.
    """
    options = {"compression": "gzip", "maxRecordsPerFile": PACKED_DOCUMENTS} if packed else {}
    return _save(df, path, "json", mode, partition_by, ignoreNullFields=False, **options)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """CSV sink with a header (K7); ``mode="append"`` adds rows without rewriting the stored ones."""
    return _save(df, path, "csv", mode, (), header=True, quote='"', escape='"')


_WRITERS = {"csv": write_csv, "json": write_json, "parquet": write_parquet}


def write_as(df: DataFrame, path: str, format_: str, mode: str = "overwrite") -> int:
    """Write one of the known formats; any other is an error (K9)."""
    if format_ not in _WRITERS:
        raise ValueError(f"unsupported format {format_!r}, expected one of {sorted(_WRITERS)}")
    return _WRITERS[format_](df, path, mode)


def write_layer(df: DataFrame | None, lake: Lake, layer: str, table: str) -> int:
    """Parquet sink on the layer path (K2); no frame writes nothing."""
    return 0 if df is None else write_parquet(df, lake.path(layer, table))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table_if_absent(
    spark: SparkSession, name: str, ddl: str, location: str | None = None, properties: Mapping[str, str] | None = None
) -> None:
    """Parquet table with the declared columns unless it exists (K8).

    Keys go along as table properties; the key checks enforce them.
    """
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet"
    if location:
        statement += f" LOCATION {_quoted(location)}"
    if properties:
        pairs = ", ".join(f"{_quoted(key)} = {_quoted(value)}" for key, value in properties.items())
        statement += f" TBLPROPERTIES ({pairs})"
    spark.sql(statement)
