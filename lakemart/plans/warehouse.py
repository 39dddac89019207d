"""Gold to warehouse."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import fixed
from lakemart.operators.checks import foreign_key_violations, primary_key_violations
from lakemart.operators.project import union_all
from lakemart.plans.report import TableReport, guarded
from lakemart.schemas import GOLD
from lakemart.sources.jdbc import JdbcTarget, write_jdbc
from lakemart.sources.paths import list_tables
from lakemart.sources.readers import read_required
from lakemart.sources.writers import create_table_if_absent, write_parquet

#: Table properties that declare keys.
PRIMARY_KEY, FOREIGN_KEY = "primary_key", "foreign_key."

TableSink = Callable[[DataFrame, str], int]


def jdbc_sink(target: JdbcTarget, mode: str = "overwrite") -> TableSink:
    return lambda df, table: write_jdbc(df, target, table, mode)


def parquet_sink(root: str) -> TableSink:
    """Warehouse kept as Parquet below ``root``."""
    return lambda df, table: write_parquet(df, f"{root.rstrip('/')}/{table}")


def load_layer(
    spark: SparkSession, root: str, sink: TableSink, at_once: int = 4, done: Callable[[TableReport], None] | None = None
) -> list[TableReport]:
    """Load every table found below ``root``; empty ones are skipped, a failing one does not stop the rest.

    ``at_once`` tables are loaded side by side, each in a scheduler pool of its
    name, so that a slow one does not hold up the others; with fair scheduling
    they share the executors.  ``done`` is called with each report as it comes;
    the reports are returned in the order of the tables.
    """

    def load(table: str, path: str) -> TableReport:
        df = read_required(spark, path)
        if df is None:
            return TableReport(table, path, fixed.SKIPPED_EMPTY, 0)
        return TableReport(table, path, fixed.SUCCESS, sink(df, table))

    def in_pool(table: str, path: str) -> TableReport:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
        try:
            report = guarded(table, path, lambda: load(table, path))
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        if done is not None:
            done(report)
        return report

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(in_pool), *found) for found in list_tables(spark, root).items()]]


def declared_keys(spark: SparkSession, table: str) -> tuple[tuple[str, ...], dict[str, tuple[str, ...]]]:
    """Primary key of a catalog table and its foreign keys by parent, as its properties declare them (K8)."""
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}

    def columns(text: str) -> tuple[str, ...]:
        return tuple(c.strip() for c in text.split(",") if c.strip())

    parents = {k.removeprefix(FOREIGN_KEY): columns(v) for k, v in properties.items() if k.startswith(FOREIGN_KEY)}
    return columns(properties.get(PRIMARY_KEY, "")), parents


def check_table(spark: SparkSession, table: str) -> DataFrame:
    """Violations of the keys that a catalog table declares: ``kind, parent, key, n_rows``, the key as text (K8, Q1, Q2).

    Parents are tables of the same database and are matched on their own
    declared primary keys.
    """
    database, _, _ = table.rpartition(".")
    primary, foreign = declared_keys(spark, table)
    rows = spark.table(table)

    def named(violations: DataFrame, kind: str, parent: str | None, keys: tuple[str, ...]) -> DataFrame:
        key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
        return violations.select(F.lit(kind).alias("kind"), F.lit(parent).cast("string").alias("parent"), key.alias("key"), "n_rows")

    found = [named(primary_key_violations(rows, primary), "primary", None, primary)] if primary else []
    for parent, columns in foreign.items():
        name = f"{database}.{parent}" if database else parent
        broken = foreign_key_violations(rows, columns, spark.table(name), declared_keys(spark, name)[0])
        found.append(named(broken, "foreign", parent, columns))
    return union_all(found) if found else spark.createDataFrame([], "kind string, parent string, key string, n_rows bigint")


def create_tables(spark: SparkSession, database: str = "default", root: str | None = None) -> None:
    """Every declared table unless it exists, its keys as properties; below ``root`` when one is given."""
    for table in GOLD.values():
        keys = {PRIMARY_KEY: ", ".join(table.primary_key)}
        for columns, parent in table.foreign_keys:
            keys[f"{FOREIGN_KEY}{parent}"] = ", ".join(columns)
        location = f"{root.rstrip('/')}/{table.name}" if root else None
        create_table_if_absent(spark, f"{database}.{table.name}", table.ddl, location, keys)
