"""Key checks that stand in for table constraints (Q1, Q2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.filters import present
from lakemart.operators.project import union_all
from lakemart.schemas import GOLD


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat or hold a NULL, with the number of rows (Q1)."""
    has_null = reduce(or_, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(has_null | (F.col("n_rows") > 1))
        .withColumn("problem", F.when(has_null, F.lit("null")).otherwise(F.lit("duplicate")))
    )


def foreign_key_violations(
    child: DataFrame, keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str] | None = None
) -> DataFrame:
    """Child keys without a parent, with the number of rows; a key with a NULL part refers to nothing (Q2).

    Child rows are counted per key first, so the join sees each key once
    however many rows share it.
    """
    names = list(parent_keys or keys)
    known = parent.select(*[F.col(p).alias(k) for k, p in zip(keys, names, strict=True)])
    counted = child.filter(present(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(known, list(keys), "left_anti")


def check_declared_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared key of the given gold tables: violating keys and rows."""

    def summary(violations: DataFrame, table: str, kind: str, keys: Sequence[str], parent: str | None) -> DataFrame:
        return violations.agg(
            F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")
        ).select(
            F.lit(table).alias("table"),
            F.lit(kind).alias("kind"),
            F.lit(", ".join(keys)).alias("key"),
            F.lit(parent).cast("string").alias("parent"),
            "n_keys",
            "n_rows",
        )

    rows = []
    for name, df in tables.items():
        declared = GOLD[name]
        keys = declared.primary_key
        rows.append(summary(primary_key_violations(df, keys), name, "primary", keys, None))
        for columns, parent in declared.foreign_keys:
            if parent in tables:
                broken = foreign_key_violations(df, columns, tables[parent], GOLD[parent].primary_key)
                rows.append(summary(broken, name, "foreign", columns, parent))
    return union_all(rows)
