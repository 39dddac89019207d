"""Connected components of a table of edges, by alternating star contraction.

Before the rounds every task joins the edges it holds by union-find and passes on
a tree per component, with all its vertices right under the root.

A round points every vertex's larger neighbours, then its smaller ones, to the
smallest label in sight.  Each round is two aggregations with map-side partial
results and two joins dealt by salt, so a vertex with a third of all edges
stays spread; its result is written to the shared scratch folder, which cuts
the lineage.  The number of rounds grows with the logarithm of the longest
path.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import salted_join, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    pairs = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return edges.select(F.inline(pairs))


def _star(sides: DataFrame) -> DataFrame:
    """Each ``v`` beside ``u`` linked to the smallest of ``u`` and its neighbours."""
    least = sides.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return salted_join(sides, least, "u", F.xxhash64("v"), "inner", 8)


#: Edges that a task joins at a time.
_JOINED = 1 << 20


def _trees(edges: list[np.ndarray]) -> pa.RecordBatch:
    """``(a, b)``: each vertex ``b`` beside the smallest ``a`` that these edges let it reach."""
    names, numbers = np.unique(np.concatenate(edges, axis=1), return_inverse=True)
    parent = list(range(len(names)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in zip(*numbers.reshape(2, -1).tolist(), strict=True):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(names))])
    below = np.flatnonzero(roots != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([pa.array(names[roots[below]]), pa.array(names[below])], names=["a", "b"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        held.append(np.stack([batch.column("a").to_numpy(), batch.column("b").to_numpy()]))
        size += batch.num_rows
        if size >= _JOINED:
            yield _trees(held)
            held, size = [], 0
    if size:
        yield _trees(held)


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``edges(a long, b long)``: the smallest id reachable.

    Ids of no edge are not returned.  Loops give no row of their own.
    """
    current = stored(_oriented(edges).mapInArrow(_joined, "a long, b long"), "edges", narrow=True)
    before = None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
        large = _star(_both_ways(current)).filter("v > u").select(F.col("v").alias("b"), F.col("least").alias("a"))
        small = _star(_oriented(large).select(F.col("b").alias("u"), F.col("a").alias("v")))
        joined = small.select(F.col("v").alias("b"), F.col("least").alias("a")).unionAll(
            small.select(F.col("u").alias("b"), F.col("least").alias("a"))
        )
        current = stored(_oriented(joined), "edges", narrow=True)
    return current.select(F.col("b").alias("id"), F.col("a").alias("component")).unionAll(
        current.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    )
