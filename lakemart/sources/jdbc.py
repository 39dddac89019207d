"""JDBC sink (K3, K4)."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from lakemart.functions import to_json_text

MODES = ("overwrite", "append", "ignore", "errorifexists")


@dataclass(frozen=True)
class JdbcTarget:
    """Where and how to load: ``partitions`` bounds the open connections, ``truncate`` keeps the table and its keys on overwrite."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    batch_size: int = 10_000
    partitions: int | None = 32
    truncate: bool = False

    @classmethod
    def postgres(cls, config: Mapping[str, str] | None = None, **options: object) -> JdbcTarget:
        """Target from a mapping, or from POSTGRES_* variables when none is given."""
        names = {"host": "HOST", "port": "PORT", "database": "DB", "user": "USER", "password": "PASSWORD"}
        values = dict(config) if config else {k: os.environ.get(f"POSTGRES_{v}") for k, v in names.items()}
        missing = [k for k in names if not values.get(k)]
        if missing:
            raise ValueError(f"missing database settings: {missing}")
        return cls(
            url=f"jdbc:postgresql://{values['host']}:{values['port']}/{values['database']}",
            properties={"user": values["user"], "password": values["password"], "driver": "org.postgresql.Driver"},
            **options,
        )


def prepare_for_jdbc(df: DataFrame, keep_null_fields: bool = False) -> DataFrame:
    """Arrays, structs and maps as JSON text, other columns as they are (K4)."""
    return df.select(
        *[
            to_json_text(F.col(f"`{f.name}`"), keep_null_fields).alias(f.name)
            if isinstance(f.dataType, ArrayType | StructType | MapType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def write_jdbc(df: DataFrame, target: JdbcTarget, table: str, mode: str = "overwrite") -> int:
    """Load a table over JDBC; an empty input writes nothing (K3).

    Load from stored tables: the input is scanned twice, and ``partitions``
    bounds the tasks of its last stage.  Appending is at least once.

    Each task commits its own rows, so a task that runs again after its
    commit could load them twice.  A full load is therefore compared with the
    table afterwards.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    n_rows = df.count()
    if n_rows == 0:
        return 0
    options = {**target.properties, "batchsize": str(target.batch_size), "truncate": str(target.truncate).lower()}
    if target.partitions:
        options["numPartitions"] = str(target.partitions)
    prepare_for_jdbc(df).write.jdbc(target.url, table, mode=mode, properties=options)
    if mode == "overwrite":
        loaded = count_jdbc(df.sparkSession, target, table)
        if loaded != n_rows:
            raise RuntimeError(f"{table} holds {loaded} rows after a load of {n_rows}")
    return n_rows


def count_jdbc(spark: SparkSession, target: JdbcTarget, table: str) -> int:
    """Rows of a table, counted by the database."""
    query = f"(SELECT COUNT(*) AS n_rows FROM {table}) counted"
    return int(spark.read.jdbc(target.url, query, properties=dict(target.properties)).first()[0])
