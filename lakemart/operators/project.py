"""Projections and unions by name."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Wanted columns that exist, in wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
