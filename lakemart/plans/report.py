"""Run report: one row per table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession

from lakemart import fixed
from lakemart.sources.writers import write_parquet

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TableReport:
    table: str
    path: str | None
    status: str
    n_rows: int
    n_rejects: int = 0


def report_frame(spark: SparkSession, reports: Iterable[TableReport]) -> DataFrame:
    """Reports as a table; as many rows as tables were handled."""
    return spark.createDataFrame(
        [astuple(r) for r in reports], "table string, path string, status string, n_rows bigint, n_rejects bigint"
    )


def guarded(table: str, path: str | None, work: Callable[[], TableReport]) -> TableReport:
    """Run one output; a failure becomes its report row and leaves the others alone (R2)."""
    try:
        return work()
    except Exception as error:  # any failure of one table must not reach its siblings
        log.exception("table %s failed", table)
        return TableReport(table, path, f"{fixed.FAILED}{error}", 0)


def publish(table: str, path: str, df: DataFrame | None) -> TableReport:
    """Write one table in one job; no input writes nothing."""
    if df is None:
        return TableReport(table, None, fixed.SKIPPED_EMPTY, 0)
    return TableReport(table, path, fixed.SUCCESS, write_parquet(df, path))


def unless_empty(source: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """Result of ``build``, or ``None`` for an empty source.

    The test is made on the source, where the first row answers it; on the
    result it would run every shuffle of the job once more.
    """
    return None if source.isEmpty() else build(source)
