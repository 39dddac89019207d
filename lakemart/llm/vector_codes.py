"""Product codes of vectors, the nearest codebook entry found in a GNAT.

Components become integers, ``floor(scale * x)``; a vector is cut into equal
consecutive parts, each with its own codebook.  The codebooks start as the parts
of the vectors with the smallest ids and are refined by rounds: every part goes
to its nearest entry, and each entry becomes the floor of the mean of its parts.

The search tree (GNAT) over the entries of a codebook: a node has split points,
every other entry lies under the split point nearest to it, and for each pair of
split point and child the node stores the range of distances from the one to all
entries of the other.  A query computes its distances to the split points; by the
triangle inequality a child is left out where its range from any split point is
farther from the query's distance than the best entry found so far.  The test is
strict and rounds towards keeping, so that an entry at the same distance is never
left out; squared distances are integers and decide ties, to the lower index.

A round is one pass in which every task adds up its parts by entry and passes on
one row per part and entry, however many vectors it has.  The driver holds the
codebooks only, ``entries * dimension`` integers.

Defined results: a vector that is null or has a null or non-finite component is
dropped.  The dimension is that of the kept vector with the smallest id (null ids
last, ties by the vector); other lengths keep their row, with null code and
error, and train nothing.  With fewer vectors than entries, codebooks are
smaller.  Repeated rows count as often as they occur.  A null label is a label of
its own.  No kept vector gives no rows.  A dimension that the parts do not divide
and integers beyond 2**27 are errors, as 64 bits would not hold the sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import salted_join
from lakemart.sources.paths import scratch_path

#: Larger integers could overflow the sum of squares of a vector.
LARGEST = 1 << 27
#: Entries of a leaf, and split points of a node.
_LEAF, _SPLITS = 32, 16
#: Vectors searched at a time.
_BLOCK = 16384
#: Relative slack of distances that were rounded once or twice.
_SLACK = 2.0**-48


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of two integer arrays.

    Products go through floating point where every sum stays below 2**53.
    """
    largest = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * a.shape[1] * largest * largest < 1 << 53:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)).astype(np.int64)
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)


class Gnat:
    """Search tree over the rows of ``entries`` that ``members`` names."""

    def __init__(self, entries: np.ndarray, members: np.ndarray | None = None) -> None:
        self.entries = entries
        members = np.arange(len(entries)) if members is None else members
        self.splits = members if len(members) <= _LEAF else self._far_apart(members)
        self.points = entries[self.splits]
        self.children: list[Gnat | None] = [None] * len(self.splits)
        self.low = self.high = None
        rest = np.setdiff1d(members, self.splits)
        if not len(rest):
            return
        distances = squared_distances(self.points, entries[rest])
        nearest = distances.argmin(0)
        roots = np.sqrt(distances.astype(np.float64))
        self.low = np.full((len(self.splits), len(self.splits)), np.inf)
        self.high = np.full_like(self.low, -np.inf)
        for child in range(len(self.splits)):
            inside = np.flatnonzero(nearest == child)
            if len(inside):
                self.children[child] = Gnat(entries, rest[inside])
                self.low[:, child] = roots[:, inside].min(1) * (1 - _SLACK)
                self.high[:, child] = roots[:, inside].max(1) * (1 + _SLACK)

    def _far_apart(self, members: np.ndarray) -> np.ndarray:
        """Split points, each the member farthest from those chosen before; the first has the lowest index.

        Members that are all equal become a leaf.
        """
        points = self.entries[members]
        chosen = [0]
        gap = squared_distances(points, points[:1])[:, 0]
        while len(chosen) < _SPLITS:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, squared_distances(points, points[chosen[-1:]])[:, 0])
        chosen = np.unique(chosen)
        return members if len(chosen) == 1 else members[chosen]

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lower one of a tie, and the squared distance to it, per query."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.entries))
        self.compared = 0
        self._search(queries, np.arange(len(queries)), best, index, self)
        return index, best

    def _search(self, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray, top: Gnat) -> None:
        distances = squared_distances(queries[rows], self.points)
        top.compared += distances.size
        least = distances.min(1)
        # The first of equal distances is the lowest index, as split points are in ascending order.
        found = self.splits[distances.argmin(1)]
        better = (least < best[rows]) | ((least == best[rows]) & (found < index[rows]))
        best[rows[better]], index[rows[better]] = least[better], found[better]
        if self.low is None:
            return
        # The child under the nearest split point first, so that the best distance is small for the others.
        own = distances.argmin(1)
        for child, tree in enumerate(self.children):
            here = np.flatnonzero(own == child) if tree else ()
            if len(here):
                tree._search(queries, rows[here], best, index, top)
        roots = np.sqrt(distances.astype(np.float64))
        near, far = roots * (1 - _SLACK), roots * (1 + _SLACK)
        reach = np.sqrt(best[rows].astype(np.float64))[:, None] * (1 + _SLACK)
        inner, outer = (near - reach) - _SLACK * (near + reach), (far + reach) * (1 + _SLACK)
        for child, tree in enumerate(self.children):
            if tree is None:
                continue
            shut = ((inner > self.high[:, child]) | (outer < self.low[:, child])).any(1)
            here = np.flatnonzero(~shut & (own != child))
            if len(here):
                tree._search(queries, rows[here], best, index, top)


def _whole_vectors(scale: int):
    """``vec_id, label, width`` and the integers of each kept vector as 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            lists = lists.cast(pa.large_list(pa.float64()))
            width = np.array(lists.value_lengths().fill_null(-1), dtype=np.int64)
            flat = np.asarray(lists.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False), dtype=np.float64)
            owner = np.repeat(np.arange(len(width)), np.maximum(width, 0))
            keep = width >= 0
            keep[owner[~np.isfinite(flat)]] = False
            with np.errstate(over="ignore"):
                whole = np.floor(scale * flat[keep[owner]])
            if len(whole) and np.abs(whole).max() > LARGEST:
                raise ValueError(f"a component times {scale} is beyond {LARGEST}")
            whole = whole.astype(np.int32)
            ends = np.cumsum(width[keep])
            blobs = [whole[end - n : end].tobytes() for end, n in zip(ends.tolist(), width[keep].tolist(), strict=True)]
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").filter(mask), batch.column("label").filter(mask), pa.array(width[keep], pa.int32()), pa.array(blobs, pa.binary())],
                names=["vec_id", "label", "width", "vector"],
            )

    return run


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of the first row and the integers, some rows at a time; all rows have ``width``."""
    for start in range(0, batch.num_rows, _BLOCK):
        blobs = batch.column("vector").slice(start, _BLOCK).to_pylist()
        yield start, np.frombuffer(b"".join(blobs), np.int32).reshape(len(blobs), width).astype(np.int64)


def _sums(codebooks, width: int):
    """Per task: ``part, entry, n`` and the sum of the parts assigned to each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = codebooks.value
        parts, entries, step = books.shape
        trees = [Gnat(book) for book in books]
        sums, counts = np.zeros_like(books), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for _, vectors in _blocks(batch, width):
                for part, tree in enumerate(trees):
                    values = vectors[:, part * step : (part + 1) * step]
                    index, _ = tree.nearest(values)
                    counts[part] += np.bincount(index, minlength=entries)
                    order = index.argsort(kind="stable")
                    used, first = np.unique(index[order], return_index=True)
                    sums[part, used] += np.add.reduceat(values[order], first, axis=0)
        part, entry = np.nonzero(counts)
        if len(part):
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * step), pa.array(sums[part, entry].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(counts[part, entry]), lists], names=["part", "entry", "n", "total"])

    return run


def _codes(codebooks, width: int):
    """``vec_id, label, code, error`` per vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = codebooks.value
        step = books.shape[2]
        trees = [Gnat(book) for book in books]
        digits = np.array([f"{i:02x}" for i in range(books.shape[1])], dtype=object)
        for batch in batches:
            codes, errors = np.full(batch.num_rows, "", dtype=object), np.zeros(batch.num_rows, dtype=np.int64)
            for start, vectors in _blocks(batch, width):
                rows = slice(start, start + len(vectors))
                for part, tree in enumerate(trees):
                    index, distance = tree.nearest(vectors[:, part * step : (part + 1) * step])
                    codes[rows] += digits[index]
                    errors[rows] += distance
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors)], names=["vec_id", "label", "code", "error"]
            )

    return run


def _stored(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _refined(vectors: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """Codebooks after one round; at most one row per part and entry comes to the driver."""
    step = books.shape[2]
    sent = vectors.sparkSession.sparkContext.broadcast(books)
    rows = vectors.mapInArrow(_sums(sent, width), "part long, entry long, n long, total array<long>")
    totals = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(step)])
    table = totals.toArrow()
    part, entry, n, *sums = [table.column(i).to_numpy() for i in range(3 + step)]
    refined = books.copy()
    refined[part, entry] = np.stack(sums, axis=1) // n[:, None] if len(n) else 0
    sent.unpersist()
    return refined


def train_and_encode(
    table: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
) -> tuple[DataFrame, np.ndarray | None]:
    """Rows ``vec_id, label, code, error``, and the codebooks by part, entry and position.

    ``code`` is the entry's index of each part, two hex digits each, so there
    are at most 256 entries; ``error`` the sum of the squared distances.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    spark = table.sparkSession
    kind = table.schema[label].dataType.simpleString()
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    whole = _stored(rows.mapInArrow(_whole_vectors(scale), f"vec_id long, label {kind}, width int, vector binary"), "whole-vectors")
    result = f"vec_id long, label {kind}, code string, error long"
    order = (F.col("vec_id").asc_nulls_last(), "vector")
    first = whole.orderBy(*order).limit(1).collect()
    if not first:
        return spark.createDataFrame([], result), None
    width = first[0]["width"]
    if width == 0 or width % parts:
        raise ValueError(f"{parts} parts do not divide {width} components")
    fitting = whole.filter(F.col("width") == width)
    start = [np.frombuffer(r["vector"], np.int32) for r in fitting.orderBy(*order).limit(entries).collect()]
    books = np.stack(start).astype(np.int64).reshape(len(start), parts, width // parts).transpose(1, 0, 2).copy()
    vectors = fitting.select("vector")
    for _ in range(rounds):
        books = _refined(vectors, books, width)
    sent = spark.sparkContext.broadcast(books)
    coded = fitting.select("vec_id", "label", "vector").mapInArrow(_codes(sent, width), result)
    others = whole.filter(F.col("width") != width)
    return coded.unionAll(others.select("vec_id", "label", F.lit(None).cast("string"), F.lit(None).cast("long"))), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all integers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_report(table: DataFrame, **options) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every kept vector.

    ``label_error`` is the error of all vectors with the same label.
    """
    coded, books = train_and_encode(table, **options)
    coded = _stored(coded.select("vec_id", F.struct("label").alias("key"), "code", "error"), "vector-codes")
    totals = coded.groupBy("key").agg(F.sum("error").alias("label_error"))
    joined = salted_join(coded, totals, "key", F.xxhash64("vec_id", "code"), "inner", 8)
    digest = F.lit(None if books is None else books_digest(books)).cast("string")
    return joined.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def _query_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Brute force in DuckDB, a step per round."""
    steps = []
    for turn in range(rounds + 1):
        # Distances to every entry, through one row per component.
        steps.append(f"""
  a{turn} AS MATERIALIZED (
    SELECT vec_id, no, p, min(e) AS e, min(d) AS d FROM (
      SELECT v.vec_id, v.no, v.p, b.e, list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
      FROM v JOIN b{turn} b ON v.p = b.p
      QUALIFY d = min(d) OVER (PARTITION BY v.no, v.p)
    ) GROUP BY vec_id, no, p)""")
        if turn < rounds:
            steps.append(f"""
  m{turn} AS (
    SELECT p, e, list(s ORDER BY i) AS x FROM (
      SELECT p, e, i, floor(sum(x) / count(*))::BIGINT AS s
      FROM (SELECT v.p, a.e, unnest(v.x) AS x, unnest(range(1, len(v.x) + 1)) AS i FROM v JOIN a{turn} a USING (no, p))
      GROUP BY p, e, i) GROUP BY p, e),
  b{turn + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{turn} b LEFT JOIN m{turn} m USING (p, e))""")
    return f"""
  WITH k AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x,
           row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS no
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  ), v AS MATERIALIZED (
    SELECT vec_id, no, p, x[len(x) // {parts} * p + 1 : len(x) // {parts} * (p + 1)] AS x FROM k, range({parts}) r(p)
  ), b0 AS MATERIALIZED (SELECT p, no - 1 AS e, x FROM v WHERE no <= {entries}),{",".join(steps)},
  c AS (
    SELECT no, string_agg(lpad(to_hex(e), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY no
  ), h AS (
    SELECT lower(sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e))) AS codebooks_sha256 FROM b{rounds}
  )
  SELECT k.vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
  FROM k JOIN c USING (no), h
"""


QUERY_SQL = _query_sql(4, 256, 4, 1024)
