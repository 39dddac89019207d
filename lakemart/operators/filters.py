"""Row predicates (F1-F3, F7).  All push down to a Parquet scan."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_id(key: str) -> Column:
    """Key present and not 0 (F1)."""
    return F.col(key).isNotNull() & (F.col(key) != 0)


def present(*columns: str) -> Column:
    """Every named column present."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def all_true(*flags: str | Column) -> Column:
    """Every flag true; NULL counts as not true."""
    return reduce(and_, [F.coalesce(F.col(f) if isinstance(f, str) else f, F.lit(False)) for f in flags])
