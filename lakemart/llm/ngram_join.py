"""Jaccard join of documents on word shingles, by T-occurrence search (DivideSkip).

A document's set holds the codes of its distinct ``k``-word shingles; two sets
are linked when ``100 * |intersection| >= percent * |union|``.

1. Sets are digested; documents of equal sets become one node.
2. A linked set finds at least ``percent`` of its shingles elsewhere.  One pass
   deals all shingles by bucket, marks those that occur twice, and returns a
   count per document; documents below the share cannot be linked and leave.
3. The rest are put into classes of size, each set into two neighbouring ones, so
   that linked sets meet in one; there they are counted once more, now among
   themselves.  What still may be linked sends the shingles of its prefix, the
   rarest by a fixed-size count sketch: two linked sets share one of those.
   Sharing one inside a class puts sets into the same coarse cluster.
4. Each cluster is searched on its own: inverted lists, the long ones set aside,
   the short ones merged, the candidates probed in the long ones by binary
   search.  A node that has been reached leaves the lists, so a cluster of
   thousands of near copies costs about one merge.  A cluster above
   ``cluster_shingles`` is searched as pairs of blocks, each of bounded size.
5. Links span components; every document gets the smallest id of its own.

No step drops or caps rows.  Tables of keys are broadcast below
``BROADCAST_BYTES``, by their counted rows, and joined by a shuffle above.  Codes have 64 bits; a collision inside a set is
beyond practical odds.

Defined results: a document of fewer words has its whole sequence as one
shingle; without words or text it has none and is linked with nothing.  A null
id counts as larger than any other; a component of null ids only is null.
Repeated rows are linked with each other.  An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import packed, salted_join, stored, text_or_empty, unpacked
from lakemart.llm.components import components
from lakemart.llm.words import Words, mix, ranges, shingle_sets, small_batches

#: Shingles per bucket of step 2 and per task of step 4.
BUCKET_SHINGLES = 2 << 20
CLUSTER_SHINGLES = 2 << 20
SKETCH_BITS = 18
BROADCAST_BYTES = 64 << 20
#: Documents and shingles that step 2 counts at a time.
_RUN_DOCS, _RUN_SHINGLES = 60_000, 1 << 19


def _blob(values: np.ndarray) -> bytes:
    return values.tobytes()


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in small_batches(batches, "text"):
        values, first = shingle_sets(Words(batch.column("text"), lower=True), k)
        yield batch, values, first


def _digest_sets(k: int):
    """Set size and 128-bit digest per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values, first in _sets(batches, k):
            sizes = np.diff(first)
            sums = np.zeros((2, len(values) + 1), dtype=np.uint64)
            np.cumsum(mix(values + np.uint64(1)), out=sums[0, 1:])
            np.cumsum(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=sums[1, 1:])
            halves = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("hash"), pa.array(sizes), pa.array(halves[0]), pa.array(halves[1])],
                names=["doc_id", "hash", "n_shingles", "d0", "d1"],
            )

    return run


def _deal_shingles(sets, n_buckets: int):
    """Step 2, map side: per run of documents and bucket, its distinct shingles.

    A shingle that the run holds twice is known to repeat: it is counted here
    and sent once, with no document, only to tell other runs.
    """

    def flush(run_id: int, keys: list, parts: list, sizes: list) -> Iterator[tuple]:
        values, size = np.concatenate(parts), np.concatenate(sizes)
        docs = np.repeat(np.arange(len(size), dtype=np.uint16), size)
        order = np.argsort(values, kind="stable")
        values, docs = values[order], docs[order]
        new = np.ones(len(values), dtype=bool)
        new[1:] = values[1:] != values[:-1]
        group = np.cumsum(new) - 1
        seen = np.bincount(group)
        live = np.bincount(docs[seen[group] > 1], minlength=len(size)).astype(np.int32)
        ids, hashes = (np.concatenate(parts) for parts in zip(*keys, strict=True))
        yield 0, run_id, _blob(live), _blob(size.astype(np.int32)), _blob(ids), _blob(hashes)
        values, docs, seen = values[new], docs[new], seen
        docs = np.where(seen > 1, np.uint16(65535), docs)
        bucket = (values % np.uint64(n_buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        values, docs = (values[order] >> np.uint64(32)).astype(np.uint32), docs[order]
        edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            part = slice(edges[b], edges[b + 1])
            yield int(b), run_id, _blob(values[part]), _blob(docs[part]), None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run_id = TaskContext.get().partitionId() << 32
        keys, parts, sizes, n_docs, n_shingles = [], [], [], 0, 0
        for batch, values, first in sets(batches):
            for start in range(0, batch.num_rows, _RUN_DOCS):
                end = min(batch.num_rows, start + _RUN_DOCS)
                if keys and (n_docs + end - start > _RUN_DOCS or n_shingles + first[end] - first[start] > _RUN_SHINGLES):
                    yield _rows(flush(run_id, keys, parts, sizes))
                    run_id += 1
                    keys, parts, sizes, n_docs, n_shingles = [], [], [], 0, 0
                keys.append(tuple(batch.column(c).slice(start, end - start).to_numpy(zero_copy_only=False) for c in ("key", "hash")))
                parts.append(values[first[start] : first[end]])
                sizes.append(np.diff(first[start : end + 1]))
                n_docs += end - start
                n_shingles += first[end] - first[start]
        if keys:
            yield _rows(flush(run_id, keys, parts, sizes))

    return run


_RUN_SCHEMA = "bucket int, run long, a binary, b binary, c binary, d binary"


def _rows(rows: Iterator[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["bucket", "run", "a", "b", "c", "d"])


def grouped(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys as one table each; the input is sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, end in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(c[start] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _mark_repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2, per bucket: for each run how many of a document's shingles occur in another run."""
    for table in grouped(batches, "bucket"):
        out, parts = [], []
        for run, a, b, c, d in zip(*(table.column(n).to_pylist() for n in ("run", "a", "b", "c", "d")), strict=True):
            if c is not None:
                out.append((0, run, a, b, c, d))
            else:
                parts.append((run, np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint16)))
        if parts:
            values = np.concatenate([p[1] for p in parts])
            docs = np.concatenate([p[2] for p in parts])
            order = np.argsort(values, kind="stable")
            ordered = values[order]
            again = np.zeros(len(values), dtype=bool)
            same = ordered[1:] == ordered[:-1]
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            again &= docs != 65535
            start = 0
            for run, a, _ in parts:
                hit, counts = np.unique(docs[start : start + len(a)][again[start : start + len(a)]], return_counts=True)
                start += len(a)
                if len(hit):
                    out.append((1, run, _blob(hit), _blob(counts.astype(np.int32)), None, None))
        if out:
            yield _rows(iter(out))


def _keep_live(percent: int):
    """Step 2, per run: keys of the documents whose share of repeated shingles allows a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "run"):
            columns = [table.column(n).to_pylist() for n in ("bucket", "a", "b", "c", "d")]
            head = columns[0].index(0)
            live, size = (np.frombuffer(columns[i][head], np.int32).astype(np.int64) for i in (1, 2))
            for kind, a, b in zip(*columns[:3], strict=True):
                if kind == 1:
                    live[np.frombuffer(a, np.uint16)] += np.frombuffer(b, np.int32)
            keep = (size > 0) & (100 * live >= percent * size)
            keys = [np.frombuffer(columns[i][head], np.int64)[keep] for i in (3, 4)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in keys], names=["key", "hash"])

    return run


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each node that a task meets."""
    seen: set[int] = set()
    for batch in batches:
        nodes = batch.column("node").to_pylist()
        first = [not (node in seen or seen.add(node)) for node in nodes]
        yield batch if all(first) else batch.filter(pa.array(first, pa.bool_()))


def _node_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values, first in _sets(_first_of_each(batches), k):
            blobs = [_blob(values[first[i] : first[i + 1]]) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(np.diff(first)), pa.array(blobs, pa.binary())], names=["node", "n", "shingles"]
            )

    return run


def size_class(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Classes whose numbers differ by one at most for sets that may be linked."""
    return np.floor(np.log(sizes) / (math.log(100 / percent) + 1e-9)).astype(np.int64) if percent < 100 else sizes


def _in_classes(percent: int):
    """Each set twice, once per class: number ``2 * node + turn``, its codes changed by the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, sizes = batch.column("node").to_numpy(), batch.column("n").to_numpy()
            classes = size_class(sizes, percent)
            blobs = batch.column("shingles")
            for turn in (0, 1):
                codes = mix((classes + turn).astype(np.uint64) + np.uint64(1))
                changed = [_blob(np.frombuffer(b.as_buffer(), np.uint64) ^ c) for b, c in zip(blobs, codes, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(2 * nodes + turn), pa.array(sizes), pa.array(changed, pa.binary())], names=["node", "n", "shingles"])

    return run


def _read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1_000):
            part = batch.slice(start, 1_000)
            sets = [np.frombuffer(b.as_buffer(), np.uint64) for b in part.column("shingles")]
            yield part, np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])


def _read_classes(percent: int):
    """The sets in their classes, keyed for step 2; in one Python step with it."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        for part, values, first in _read_sets(_in_classes(percent)(batches)):
            keys = [part.column("node"), pa.array(np.zeros(part.num_rows, dtype=np.int64))]
            yield pa.RecordBatch.from_arrays(keys, names=["key", "hash"]), values, first

    return sets


def _slot(values: np.ndarray) -> np.ndarray:
    return (mix(values + np.uint64(7)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for batch in batches:
        for blob in batch.column("shingles"):
            counts += 0 if blob.as_buffer() is None else np.bincount(_slot(np.frombuffer(blob.as_buffer(), np.uint64)), minlength=len(counts))
    slots = np.flatnonzero(counts)
    for start in range(0, len(slots), 10_000):
        part = slots[start : start + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], names=["slot", "n"])


def _prefixes(percent: int, sketch):
    """Step 3: the prefix of each set, rarest first by the sketch, ties by code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            nodes, codes = [], []
            for node, blob in zip(batch.column("node").to_pylist(), batch.column("shingles"), strict=True):
                values = np.frombuffer(blob.as_buffer(), np.uint64)
                length = len(values) - -(-percent * len(values) // 100) + 1
                chosen = values[np.lexsort((values, counts[_slot(values)]))[:length]]
                nodes.append(np.full(len(chosen), node))
                codes.append(chosen.view(np.int64))
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(codes)), pa.array(np.concatenate(nodes))], names=["code", "node"])

    return run


class InvertedLists:
    """Inverted lists over the sets of one task; answers T-occurrence queries on what is still unreached."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.percent = percent
        self.size = np.array([len(s) for s in sets])
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        _, self.token = np.unique(np.concatenate(sets), return_inverse=True)
        self.unreached = np.ones(len(sets), dtype=bool)
        self._index(np.arange(len(sets)))

    def _index(self, docs: np.ndarray) -> None:
        places = ranges(self.start[docs], self.size[docs])
        tokens = self.token[places]
        order = np.argsort(tokens, kind="stable")
        self.ids = np.repeat(docs, self.size[docs])[order]
        n_tokens = int(self.token.max()) + 1
        self.list_start = np.searchsorted(tokens[order], np.arange(n_tokens + 1))
        self.indexed = len(docs)

    def reach(self, docs: np.ndarray) -> None:
        self.unreached[docs] = False
        left = int(self.unreached.sum())
        if left and 2 * left <= self.indexed:
            self._index(np.flatnonzero(self.unreached))

    def linked(self, query: int) -> np.ndarray:
        """Unreached documents linked with ``query``."""
        n = self.size[query]
        tokens = self.token[self.start[query] : self.start[query + 1]]
        starts = self.list_start[tokens]
        lengths = self.list_start[tokens + 1] - starts
        present = lengths > 0
        starts, lengths = starts[present], lengths[present]
        needed = -(-self.percent * int(n) // 100)  # the overlap that any linked set has at least
        if len(lengths) < needed:
            return np.zeros(0, dtype=np.int64)
        order = np.argsort(lengths)
        starts, lengths = starts[order], lengths[order]
        n_long = min(needed - 1, int(needed / (0.02 * math.log2(lengths[-1] + 1) * 8 + 1)), len(lengths))
        n_short = len(lengths) - n_long
        merged = self.ids[ranges(starts[:n_short], lengths[:n_short])]
        merged = np.sort(merged[self.unreached[merged]], kind="stable")
        found, counts = np.unique(merged, return_counts=True)
        enough = counts >= needed - n_long
        found, counts = found[enough], counts[enough]
        fits = (100 * self.size[found] >= self.percent * n) & (100 * n >= self.percent * self.size[found])
        found, counts = found[fits], counts[fits]
        for start, length in zip(starts[n_short:].tolist(), lengths[n_short:].tolist(), strict=True):
            if not len(found):
                break
            ids = self.ids[start : start + length]
            at = np.minimum(np.searchsorted(ids, found), length - 1)
            counts = counts + (ids[at] == found)
        return found[100 * counts >= self.percent * (n + self.size[found] - counts)]


def spanning_links(nodes: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that span the components of these sets: ``(node, first node of its component)``."""
    index = InvertedLists(sets, percent)
    links = []
    for first in range(len(sets)):
        if not index.unreached[first]:
            continue
        index.reach(np.array([first]))
        waiting = [first]
        while waiting and index.unreached.any():
            found = index.linked(waiting.pop())
            if len(found):
                index.reach(found)
                waiting += found.tolist()
                links += [(int(nodes[f]), int(nodes[first])) for f in found]
    return links


def _search_clusters(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "cluster", "i", "j"):
            nodes, at = np.unique(table.column("node").to_numpy(), return_index=True)
            if len(nodes) < 2:
                continue
            blobs = table.column("shingles").combine_chunks()
            blobs = blobs.chunk(0) if isinstance(blobs, pa.ChunkedArray) else blobs
            links = spanning_links(nodes, [np.frombuffer(blobs[int(i)].as_buffer(), np.uint64) for i in at], percent)
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


#: Sets are wide rows: few to an Arrow batch, or the buffers on both sides of the Python workers grow large.
_ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


@contextmanager
def _small_batches(spark: SparkSession):
    """Small Arrow batches for the steps that run inside; the session's settings come back after them."""
    before = {key: spark.conf.get(key, None) for key in _ARROW}
    for key, value in _ARROW.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _partitions(spark: SparkSession, rows: int, each: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def _documents(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Id, text, and a key that is never null."""
    content = text_or_empty(text)
    identity = F.col(doc_id).cast("long")
    return docs.select(
        identity.alias("doc_id"), F.coalesce(identity, F.lit(-(2**63))).alias("key"), F.xxhash64(content).alias("hash"), content.alias("text")
    )


def _checked(table: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table, to be broadcast if its counted rows are few enough."""
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


def _suspects(rows: DataFrame, sets, percent: int, total: int) -> DataFrame:
    """Step 2: ``key, hash`` of the rows of which enough shingles occur in another row, or twice in a run."""
    spread = _partitions(rows.sparkSession, total, BUCKET_SHINGLES)
    dealt = rows.mapInArrow(_deal_shingles(sets, spread), _RUN_SCHEMA)
    marked = dealt.repartition(spread, "bucket").sortWithinPartitions("bucket").mapInArrow(_mark_repeated, _RUN_SCHEMA)
    per_run = marked.repartition(spread, "run").sortWithinPartitions("run")
    return per_run.mapInArrow(_keep_live(percent), "key long, hash long").distinct()


def _sharing(prefixes: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect the nodes of every code, few for a cluster that shares many codes.

    A node is linked to the smallest node that any of its codes has, and takes
    that as its label; then labels that still share a code are linked.
    """

    def with_least(rows: DataFrame) -> DataFrame:
        least = rows.groupBy("code").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
        return salted_join(rows, least.select("code", "least"), "code", F.xxhash64("node"), "inner", 8)

    shared = stored(with_least(prefixes), "shared", narrow=True)
    labels = stored(shared.groupBy("node").agg(F.min("least").alias("label")), "labels", narrow=True)
    labelled = shared.join(_checked(labels, 24), "node").select("code", F.col("label").alias("node")).distinct()
    left = with_least(labelled).select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    return labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionAll(left)


def _links(sets: DataFrame, percent: int, cluster_shingles: int) -> DataFrame:
    """Steps 3 and 4: links that span the components of the stored sets."""
    spark = sets.sparkSession
    schema = "node long, n long, shingles binary"
    classed = sets.mapInArrow(_in_classes(percent), schema)
    total = 2 * (sets.agg(F.sum("n")).first()[0] or 0)
    left = stored(_suspects(sets, _read_classes(percent), percent, total).select(F.col("key").alias("node")), "left", narrow=True)
    units = stored(classed.join(_checked(left, 16), "node"), "units")
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    slots = units.select("shingles").mapInArrow(_count_slots, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    for slot, n in slots.toArrow().to_pandas().itertuples(index=False):  # at most 2 ** SKETCH_BITS rows
        counts[slot] = n
    sketch = spark.sparkContext.broadcast(counts)
    prefixes = stored(units.select("node", "shingles").mapInArrow(_prefixes(percent, sketch), "code long, node long"), "prefixes")
    clusters = components(_sharing(prefixes))
    clusters = stored(clusters.withColumnRenamed("id", "node"), "clusters", narrow=True)
    blocks = (
        units.select("node", "n")
        .join(_checked(clusters, 24), "node")
        .groupBy("component")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") > cluster_shingles)
        .select("component", F.ceil(F.col("n") * 2 / cluster_shingles).cast("int").alias("blocks"))
    )
    named = stored(salted_join(clusters, blocks, "component", F.xxhash64("node"), "left", 8).fillna({"blocks": 1}), "blocks", narrow=True)
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = (
        units.join(_checked(named, 32), "node")
        .select("component", "node", "shingles", own.alias("own"), F.explode(every).alias("other"))
        .select(F.col("component").alias("cluster"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "shingles")
    )
    tasks = _partitions(spark, total, CLUSTER_SHINGLES)
    searched = dealt.repartition(tasks, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(_search_clusters(percent), "a long, b long")
    return searched.select(F.expr("a div 2").alias("a"), F.expr("b div 2").alias("b"))


def _one_set_per_node(rows: DataFrame, k: int, nodes: int) -> DataFrame:
    """Stored ``node, n, shingles``; rows of one id and text share a node, and one of them stands for it."""
    sets = stored(rows.select("node", "text").mapInArrow(_node_sets(k), "node long, n long, shingles binary"), "sets")
    return sets if sets.count() == nodes else stored(sets.dropDuplicates(["node"]), "sets")


def _classes_and_links(
    docs: DataFrame, k: int, percent: int, text: str, doc_id: str, cluster_shingles: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables: a row per document, a row per distinct set, and the component of every linked set."""
    rows = _documents(docs, text, doc_id)
    schema = "doc_id long, hash long, n_shingles long, d0 long, d1 long"
    keys = rows.select("doc_id", "hash", "text").mapInArrow(_digest_sets(k), schema)
    keys = stored(keys.withColumn("row_no", F.monotonically_increasing_id()), "set-digests")
    total = keys.agg(F.sum("n_shingles")).first()[0] or 0
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    classes = stored(
        keys.filter("n_shingles > 0")
        .groupBy("d0", "d1", "n_shingles")
        .agg(
            F.min("row_no").alias("node"),
            F.min("doc_id").alias("least_id"),
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), key.alias("key"), "hash")).alias("first"),
        ),
        "set-classes",
        narrow=True,
    )
    suspects = _suspects(rows.select("key", "hash", "text"), lambda batches: _sets(batches, k), percent, total)
    chosen = stored(
        classes.select("node", "first.key", "first.hash").join(suspects, ["key", "hash"], "left_semi"), "suspects", narrow=True
    )
    sets = _one_set_per_node(rows.select("key", "hash", "text").join(_checked(chosen, 32), ["key", "hash"]), k, chosen.count())
    found = stored(components(_links(sets, percent, cluster_shingles)).withColumnRenamed("id", "node"), "found", narrow=True)
    return keys, classes, found


def _digest() -> Column:
    return F.struct("d0", "d1", "n_shingles")


def _named(classes: DataFrame, found: DataFrame) -> DataFrame:
    """The sets that are linked, or held twice: ``digest, component_id``, and ``kept``, the document that stands for the component."""
    labelled = classes.join(found, "node", "left").withColumn("label", F.coalesce("component", "node"))
    joined = labelled.filter((F.col("n") > 1) | F.col("component").isNotNull())
    least = joined.groupBy("label").agg(F.min("least_id").alias("component_id"), F.min("first").alias("kept"))
    named = salted_join(joined, least, "label", F.xxhash64("node"), "inner", 8)
    return named.select(_digest().alias("digest"), "component_id", "kept", F.lit(True).alias("named"))


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    text: str = "text",
    doc_id: str = "doc_id",
    cluster_shingles: int = CLUSTER_SHINGLES,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    with _small_batches(docs.sparkSession):
        keys, classes, found = _classes_and_links(docs, k, percent, text, doc_id, cluster_shingles)
    named = _named(classes, found).drop("kept")
    documents = keys.select("doc_id", "n_shingles", _digest().alias("digest"), "row_no")
    result = salted_join(documents, named, "digest", F.xxhash64("row_no"), "left", 8)
    return result.select(
        "doc_id", "n_shingles", F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Documents with one row of each component, the one whose id names it; all columns kept.

    Rows are told apart by id and text, so rows that share the id of a dropped
    document are dropped with it only if their text's set is in the same
    component, and a null id is dropped like others.  Where texts share the
    smallest id, or all ids are null, a hash of the text decides; where rows
    share both, a hash of their whole content.  Documents without words are
    linked with nothing and stay.
    """
    with _small_batches(docs.sparkSession):
        keys, classes, found = _classes_and_links(docs, k, percent, text, doc_id, CLUSTER_SHINGLES)
    identity = F.coalesce("doc_id", F.lit(-(2**63)))
    documents = keys.select(identity.alias("key"), "hash", _digest().alias("digest"), "row_no")
    linked = salted_join(documents, _named(classes, found).select("digest", "kept"), "digest", F.xxhash64("row_no"), "inner", 8)
    dropped = (F.col("key") != F.col("kept.key")) | (F.col("hash") != F.col("kept.hash"))
    counted = linked.groupBy("key", "hash", dropped.alias("dropped")).agg(F.count(F.lit(1)).alias("n")).filter("dropped or n > 1")
    counted = stored(counted.select("key", "hash", "dropped"), "dropped", narrow=True)
    gone, again = counted.filter("dropped").select("key", "hash"), counted.filter("not dropped").select("key", "hash")
    identity = F.col(doc_id).cast("long")
    rows = packed(docs, F.coalesce(identity, F.lit(-(2**63))).alias("key"), F.xxhash64(text_or_empty(text)).alias("hash"))
    left = rows.join(_checked(gone, 32), ["key", "hash"], "left_anti")
    if again.isEmpty():
        return unpacked(left.select("row"))
    again = _checked(again, 32)
    order = "row.`{}` IS NULL, xxhash64(to_json(row))".format(doc_id)
    one = (
        left.join(again, ["key", "hash"], "left_semi")
        .withColumn("place", F.expr(f"row_number() OVER (PARTITION BY key, hash ORDER BY {order})"))
        .filter("place = 1")
    )
    return unpacked(left.join(again, ["key", "hash"], "left_anti").select("row").unionAll(one.select("row")))


def _query_sql(k: int, percent: int) -> str:
    """Brute force in DuckDB: all pairs of distinct sets of compatible size that share a shingle."""
    return rf"""
  WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w FROM documents
  ), s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[]
      WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
      ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' ')))) END AS g
    FROM d
  ), c AS (SELECT g, min(doc_id) AS c, len(g) AS n FROM s WHERE len(g) > 0 GROUP BY g),
  t AS (SELECT c, n, unnest(g) AS t FROM c),
  f AS (SELECT t FROM t GROUP BY t HAVING count(*) > 1),
  l AS (SELECT c, n, t FROM t JOIN f USING (t) QUALIFY 100 * count(*) OVER (PARTITION BY c) >= {percent} * n),
  p AS (
    SELECT a.c AS a, b.c AS b FROM l a JOIN l b ON a.t = b.t AND a.c < b.c
      AND 100 * a.n >= {percent} * b.n AND 100 * b.n >= {percent} * a.n
    GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
  ), e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
  r AS (SELECT c AS a, c AS b FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
  m AS (SELECT a AS c, min(b) AS component_id FROM r GROUP BY a)
  SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id
  FROM s LEFT JOIN c USING (g) LEFT JOIN m USING (c)
"""


QUERY_SQL = _query_sql(3, 90)
