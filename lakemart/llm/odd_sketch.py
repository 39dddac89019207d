"""Near duplicates by MinHash bands, odd sketches and exact sets.

A document's set holds the codes of its distinct ``k``-word shingles; two sets
are linked when ``100 * |intersection| >= percent * |union|``.

1. One pass over the texts gives each document the digest of its set, the keys of
   48 bands of 4 MinHash values, and an odd sketch: its 192 MinHash values, each
   with its number, are hashed into 1024 bits, and a bit holds the parity of what
   fell on it.  Documents of equal sets become one node.
2. The sketches of two sets differ in about ``512 * (1 - exp(-4 * 192 * (1 - J) / 1024))``
   bits, J being their similarity; ``estimated_similarity`` inverts that.  The
   estimate is sharpest where J is large, so it decides which candidates are
   worth an exact test.  A pair is dropped only above ``most_different_bits``: two
   linked sets exceed it once in 10**12, by the exact law of the bit count.
3. Nodes that share a band key are candidates.  Each is compared with the
   smallest node of the key; keys whose nodes are then not all connected are
   compared inside.  What sketches connect is a cluster.
4. Clusters are searched on full sets: overlaps are counted exactly, for the
   pairs that sketches admit and that are not yet connected.  A cluster above
   ``cluster_shingles`` is split into blocks, each searched alone, with one common
   set; then only sets outside the largest component meet the other blocks, so
   that a block costs nothing further where all are near copies.
5. Links span components; every document gets the smallest id of its own.

At 0.8 a pair shares no band once in 10**11.  No step drops or caps rows, and
none lists the pairs of a group.

Defined results: a document of fewer words has its whole sequence as one
shingle; without words or text it has none and is linked with nothing.  A null
id counts as larger than any other; a component of null ids only is null, and
keeps its rows.  Repeated rows are linked with each other.  An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm import ngram_join
from lakemart.llm.common import salted_join, stored, text_or_empty
from lakemart.llm.components import components
from lakemart.llm.ngram_join import grouped
from lakemart.llm.words import Words, mix, ranges, shingle_sets, small_batches

BANDS, ROWS = 48, 4
SAMPLES = BANDS * ROWS
BITS = 1024
WORDS = BITS // 64
#: A linked pair is taken for different once in so many.
RISK = 1e-12
#: Shingles that a task searches at a time.
CLUSTER_SHINGLES = 1 << 20
#: Nodes of a band key that a task compares at a time.
KEY_NODES = 4096
BROADCAST_BYTES = 64 << 20
_SALTS = 8

_RANDOM = np.random.default_rng(777)
_FACTOR = _RANDOM.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSET = _RANDOM.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_NUMBER = _RANDOM.integers(1, 2**63, SAMPLES, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Documents whose sketches are folded at a time.
_FOLD = 2000


# --- signatures ---------------------------------------------------------------------------------


def min_hashes(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The 192 MinHash values of every set; the sets must not be empty."""
    found = np.empty((len(first) - 1, SAMPLES), dtype=np.uint64)
    for i in range(SAMPLES):
        found[:, i] = np.minimum.reduceat(values * _FACTOR[i] + _OFFSET[i], first[:-1])
    return found


def band_keys(samples: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, different bands having different keys."""
    mixed = mix(samples).reshape(len(samples), BANDS, ROWS)
    sums = (mixed * _PLACE).sum(axis=2, dtype=np.uint64)
    return mix(sums + mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(1)))


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of every row of samples, as 64-bit words."""
    out = np.empty((len(samples), WORDS), dtype=np.uint64)
    for start in range(0, len(samples), _FOLD):
        part = samples[start : start + _FOLD]
        bit = (mix(part ^ _NUMBER) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
        counts = np.bincount((bit + np.arange(len(part))[:, None] * BITS).ravel(), minlength=len(part) * BITS)
        packed = np.packbits((counts & 1).astype(np.uint8), bitorder="little")
        out[start : start + _FOLD] = packed.view(np.uint64).reshape(len(part), WORDS)
    return out


def differing_bits(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ many).sum(axis=-1, dtype=np.int64)


def estimated_similarity(bits: float) -> float:
    """Similarity of two sets whose sketches differ in ``bits`` bits."""
    share = min(2 * bits / BITS, 1 - 1e-9)
    return max(0.0, 1 + BITS / (4 * SAMPLES) * math.log(1 - share))


@lru_cache
def most_different_bits(percent: int) -> int:
    """Bits in which the sketches of sets just similar enough differ at most, but for ``RISK``.

    A sample differs with chance ``1 - J`` and then turns two bits drawn at
    random; the number of odd bits after each is followed step by step.
    """
    chance = 1 - percent / 100
    odd = np.zeros(BITS + 1)
    odd[0] = 1.0
    share = np.arange(BITS + 1) / BITS
    total = np.zeros(BITS + 1)
    for differing in range(SAMPLES + 1):
        total += math.comb(SAMPLES, differing) * chance**differing * (1 - chance) ** (SAMPLES - differing) * odd
        for _ in range(2):
            up, down = odd * (1 - share), odd * share
            odd = np.concatenate([[0], up[:-1]]) + np.concatenate([down[1:], [0]])
    return int(np.flatnonzero(np.cumsum(total[::-1])[::-1] > RISK).max())


def _lists(values: np.ndarray, full: np.ndarray) -> pa.Array:
    """A list column: the rows of ``values`` where ``full``, empty lists elsewhere."""
    offsets = np.concatenate([[0], np.cumsum(np.where(full, values.shape[1], 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel().view(np.int64)))


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            values, first = shingle_sets(Words(batch.column("text"), lower=True), k)
            sizes = np.diff(first)
            full = sizes > 0
            sums = np.zeros((2, len(values) + 1), dtype=np.uint64)
            np.cumsum(mix(values + np.uint64(1)), out=sums[0, 1:])
            np.cumsum(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=sums[1, 1:])
            digests = [pa.array((s[first[1:]] - s[first[:-1]]).view(np.int64)) for s in sums]
            samples = min_hashes(values, np.concatenate([first[:-1][full], first[-1:]])) if len(values) else np.zeros((0, SAMPLES), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("hash"), pa.array(sizes), *digests, _lists(odd_sketches(samples), full), _lists(band_keys(samples), full)],
                names=["doc_id", "hash", "n_shingles", "d0", "d1", "sketch", "bands"],
            )

    return run


# --- candidates ---------------------------------------------------------------------------------


def _tasks(frame: DataFrame, rows: int, each: int) -> int:
    return max(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def _lookup(left: DataFrame, right: DataFrame, key: str, salt: Column, row_bytes: int, how: str = "inner") -> DataFrame:
    """Join with a stored table that holds each key once: broadcast while its counted rows are few, dealt by salt above."""
    if right.count() * row_bytes <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), key, how)
    return salted_join(left, right, key, salt, how, _SALTS)


def _bit_count(a: str, b: str) -> Column:
    total = F.lit(0)
    for i in range(WORDS):
        total = total + F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return total


class Unions:
    """Labels of the nodes of one task, merged as links are found."""

    def __init__(self, labels: np.ndarray) -> None:
        _, self.label = np.unique(labels, return_inverse=True)

    def others(self, node: int) -> np.ndarray:
        return np.flatnonzero(self.label != self.label[node])

    def join(self, node: int, found: np.ndarray) -> np.ndarray:
        """Merges the components of ``found`` with the node's; returns one of ``found`` for each."""
        labels, at = np.unique(self.label[found], return_index=True)
        self.label[np.isin(self.label, labels)] = self.label[node]
        return found[at]


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _matrix(table: pa.Table, at: np.ndarray) -> np.ndarray:
    """Sketches of the rows ``at``."""
    return np.asarray(_column(table, "sketch").flatten()).view(np.uint64).reshape(table.num_rows, WORDS)[at]


def _compare_in_keys(limit: int):
    """Links ``(a, b)`` between labels of nodes of a key whose sketches admit them, spanning what they connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "band", "i", "j"):
            _, at = np.unique(table.column("node").to_numpy(), return_index=True)
            labels = table.column("label").to_numpy()[at]
            sketches = _matrix(table, at)
            unions, links = Unions(labels), []
            for node in range(len(at)):
                rest = unions.others(node)
                near = rest[differing_bits(sketches[node], sketches[rest]) <= limit]
                links += [(labels[node], labels[other]) for other in (unions.join(node, near) if len(near) else ())]
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _paired(rows: DataFrame, group: str, blocks: Column, *columns: str) -> DataFrame:
    """Each row once per pair of blocks of its group that holds its own, as ``i <= j``."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    every = rows.withColumn("blocks", blocks).select(group, *columns, own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return every.select(group, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *columns)


def _few_edges(close: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect what ``close`` does: a node to its smallest partner, and that to the others.

    In a group of near copies many bands have the same few smallest nodes, so
    that little more than an edge per node is left.
    """
    label = stored(close.groupBy("node").agg(F.min("least").alias("label")), "least-partners", narrow=True)
    between = _lookup(close, label, "node", F.xxhash64("least"), 24).filter("label <> least")
    between = between.select(F.col("label").alias("a"), F.col("least").alias("b")).distinct()
    return label.select(F.col("label").alias("a"), F.col("node").alias("b")).unionAll(between)


def sketch_clusters(nodes: DataFrame, percent: int) -> DataFrame:
    """``(id, component)`` for the nodes that sketches of shared bands connect; takes ``node, sketch, bands``."""
    limit = most_different_bits(percent)
    spread = F.xxhash64("node")
    keyed = nodes.select("node", F.explode("bands").alias("band"))
    least = keyed.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    shared = stored(least.select("band", "least"), "bands", narrow=True)
    members = stored(_lookup(keyed, shared, "band", spread, 24).select("band", "node", "least"), "members")
    named = members.select("node").distinct()
    sketches = stored(nodes.select("node", "sketch").join(named, "node", "left_semi"), "sketches")
    pairs = stored(members.filter("node <> least").select("node", "least").distinct(), "pairs", narrow=True)
    size = WORDS * 8 + 24
    beside = _lookup(pairs, sketches.withColumnRenamed("sketch", "own"), "node", F.xxhash64("least"), size)
    beside = _lookup(beside, sketches.select(F.col("node").alias("least"), "sketch"), "least", spread, size)
    close = stored(beside.filter(_bit_count("own", "sketch") <= limit).select("node", "least"), "close", narrow=True)
    labels = stored(components(_few_edges(close)), "labels", narrow=True)
    # Keys of at least three nodes that are not all connected yet; of two nodes the only pair has been compared.
    labelled = _lookup(members.select("band", "node"), labels.withColumnsRenamed({"id": "node", "component": "label"}), "node", F.xxhash64("band"), 24, "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    open_ = labelled.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    open_ = stored(open_.filter("low < high AND n > 2").select("band", "n"), "open-bands", narrow=True)
    if open_.isEmpty():
        return labels
    rows = stored(_lookup(labelled, open_, "band", spread, 24), "open-members")
    rows = _lookup(rows, sketches, "node", F.xxhash64("band"), size)
    blocks = F.when(F.col("n") > KEY_NODES, F.ceil(F.col("n") * 2 / KEY_NODES)).otherwise(1).cast("int")
    dealt = _paired(rows, "band", blocks, "node", "label", "sketch")
    dealt = dealt.repartition(_tasks(nodes, 0, 1), "band", "i", "j").sortWithinPartitions("band", "i", "j")
    more = dealt.mapInArrow(_compare_in_keys(limit), "a long, b long")
    return stored(components(labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(more)), "clusters", narrow=True)


# --- exact links --------------------------------------------------------------------------------


def _node_sets(k: int):
    """Set and sketch of each node, once per task however many rows have its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            new = []
            for node in whole.column("node").to_pylist():
                new.append(node not in seen)
                seen.add(node)
            for batch in small_batches(iter([whole.filter(pa.array(new, pa.bool_()))]), "text"):
                values, first = shingle_sets(Words(batch.column("text"), lower=True), k)
                blobs = [values[first[i] : first[i + 1]].tobytes() for i in range(batch.num_rows)]
                sketches = odd_sketches(min_hashes(values, first))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), batch.column("cluster"), pa.array(np.diff(first)), pa.array(blobs, pa.binary()), _lists(sketches, np.ones(batch.num_rows, bool))],
                    names=["node", "cluster", "n", "shingles", "sketch"],
                )

    return run


def spanning_links(sets: list[np.ndarray], sketches: np.ndarray, labels: np.ndarray, asks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Exact links of the sets ``asks`` with all others, enough to span what they and equal ``labels`` connect."""
    size = np.array([len(s) for s in sets])
    start = np.concatenate([[0], np.cumsum(size)])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    mine = np.zeros(int(token.max()) + 1, dtype=np.int64)
    limit = most_different_bits(percent)
    unions, links = Unions(labels), []
    for node in np.flatnonzero(asks).tolist():
        rest = unions.others(node)
        rest = rest[(100 * size[rest] >= percent * size[node]) & (100 * size[node] >= percent * size[rest])]
        rest = rest[differing_bits(sketches[node], sketches[rest]) <= limit]
        if not len(rest):
            continue
        own = token[start[node] : start[node + 1]]
        mine[own] = 1
        places = ranges(start[rest], size[rest])
        both = np.add.reduceat(mine[token[places]], np.cumsum(size[rest]) - size[rest])
        mine[own] = 0
        linked = rest[100 * both >= percent * (size[rest] + size[node] - both)]
        links += [(node, int(other)) for other in (unions.join(node, linked) if len(linked) else ())]
    return links


def _search(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "cluster", "i", "j"):
            asked = table.column("asks").to_numpy()
            # A node dealt twice counts once, as one that asks if either does.
            order = np.lexsort((~asked, table.column("node").to_numpy()))
            nodes, at = np.unique(table.column("node").to_numpy()[order], return_index=True)
            at = order[at]
            if len(nodes) < 2:
                continue
            blobs = _column(table, "shingles")
            sets = [np.frombuffer(blobs[int(i)].as_buffer(), np.uint64) for i in at]
            links = spanning_links(sets, _matrix(table, at), table.column("label").to_numpy()[at], asked[at], percent)
            if links:
                a, b = np.array(links).T
                yield pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], names=["a", "b"])

    return run


def _searched(dealt: DataFrame, percent: int, total: int, each: int) -> DataFrame:
    dealt = dealt.select("cluster", "i", "j", "node", "label", "asks", "shingles", "sketch").repartition(_tasks(dealt, total, each), "cluster", "i", "j")
    return dealt.sortWithinPartitions("cluster", "i", "j").mapInArrow(_search(percent), "a long, b long")


def linked_components(sets: DataFrame, percent: int, cluster_shingles: int = CLUSTER_SHINGLES) -> DataFrame:
    """``(id, component)`` of the linked nodes; takes stored ``node, cluster, n, shingles, sketch``."""
    sizes = stored(sets.groupBy("cluster").agg(F.sum("n").alias("size"), F.min("node").alias("first")), "cluster-sizes", narrow=True)
    total = sizes.agg(F.sum("size")).first()[0] or 0
    blocks = F.when(F.col("size") > cluster_shingles, F.ceil(F.col("size") * 2 / cluster_shingles)).otherwise(1).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    known = _lookup(sets, sizes.select("cluster", "first", blocks.alias("blocks")), "cluster", F.xxhash64("node"), 32)
    block = F.when(F.col("node") == F.col("first"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    alone = known.select("*", F.explode(block).alias("i"), F.lit(0).alias("j"), F.col("node").alias("label"), F.lit(True).alias("asks"))
    found = stored(components(_searched(alone, percent, total, cluster_shingles)), "linked", narrow=True)
    if sizes.filter(F.col("size") > cluster_shingles).isEmpty():
        return found
    labels = found.withColumnsRenamed({"id": "node", "component": "label"})
    split = _lookup(known.filter("blocks > 1").withColumn("own", own), labels, "node", F.xxhash64("cluster"), 24, "left").withColumn("label", F.coalesce("label", "node"))
    by_label = stored(split.groupBy("cluster", "label").agg(F.sum("n").alias("size")), "label-sizes", narrow=True)
    outside = by_label.groupBy("cluster").agg(F.max_by("label", F.struct("size", "label")).alias("largest"), (F.sum("size") - F.max("size")).alias("left"))
    outside = outside.filter(F.col("left") > 0).select("cluster", "largest", F.ceil(F.col("left") * 2 / cluster_shingles).cast("int").alias("turns"))
    split = _lookup(split, stored(outside, "outside", narrow=True), "cluster", F.xxhash64("node"), 32)
    everyone = split.select("*", F.col("own").alias("i"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("j"), F.lit(False).alias("asks"))
    turn = F.pmod(F.xxhash64("node", F.lit("turn")), F.col("turns")).cast("int")
    asking = split.filter("label <> largest").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), turn.alias("j"), F.lit(True).alias("asks"))
    more = _searched(everyone.unionByName(asking), percent, total, cluster_shingles)
    return stored(components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(more)), "linked", narrow=True)


# --- documents ----------------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id", cluster_shingles: int = CLUSTER_SHINGLES
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``; ``kept`` where the id names its component."""
    content = text_or_empty(f"`{text}`")
    identity = F.col(f"`{doc_id}`").cast("long")
    no_id = F.lit(-(2**63))
    rows = docs.select(identity.alias("doc_id"), F.coalesce(identity, no_id).alias("key"), F.xxhash64(content).alias("hash"), content.alias("text"))
    schema = "doc_id long, hash long, n_shingles long, d0 long, d1 long, sketch array<long>, bands array<long>"
    signed = rows.select("doc_id", "hash", "text").mapInArrow(_signatures(k), schema)
    signed = stored(signed.withColumn("row_no", F.monotonically_increasing_id()), "signatures")
    digest = F.struct("d0", "d1", "n_shingles").alias("digest")
    classes = signed.filter("n_shingles > 0").groupBy("d0", "d1", "n_shingles")
    classes = classes.agg(F.min("row_no").alias("node"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n"))
    classes = stored(classes.select(digest, "node", "least_id", "n"), "classes", narrow=True)
    repeated = classes.filter("n > 1").select("digest", F.col("node").alias("first"))
    single = _lookup(signed.filter("n_shingles > 0").withColumn("digest", digest), repeated, "digest", F.xxhash64("row_no"), 56, "left")
    nodes = single.filter("first IS NULL OR first = row_no").select(F.col("row_no").alias("node"), "sketch", "bands")
    clusters = sketch_clusters(nodes, percent).select(F.col("id").alias("row_no"), F.col("component").alias("cluster"))
    names = _lookup(signed.select("row_no", F.coalesce("doc_id", no_id).alias("key"), "hash"), stored(clusters, "in-clusters"), "row_no", F.xxhash64("row_no"), 24)
    names = stored(names.withColumnRenamed("row_no", "node"), "names")
    n_nodes = names.count()
    chosen = F.broadcast(names) if n_nodes * 40 <= BROADCAST_BYTES else names
    texts = rows.select("key", "hash", "text").join(chosen, ["key", "hash"]).select("node", "cluster", "text")
    sets = stored(texts.mapInArrow(_node_sets(k), "node long, cluster long, n long, shingles binary, sketch array<long>"), "sets")
    if sets.count() > n_nodes:
        sets = stored(sets.dropDuplicates(["node"]), "sets")
    found = linked_components(sets, percent, cluster_shingles).select(F.col("id").alias("node"), "component")
    labelled = classes.join(found, "node", "left").withColumn("label", F.coalesce("component", "node"))
    joined = labelled.filter((F.col("n") > 1) | F.col("component").isNotNull())
    least = joined.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = stored(salted_join(joined, least, "label", F.xxhash64("node"), "inner", _SALTS).select("digest", "component_id", F.lit(True).alias("named")), "named", narrow=True)
    result = _lookup(signed.select("doc_id", "n_shingles", digest, "row_no"), named, "digest", F.xxhash64("row_no"), 48, "left")
    component = F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


QUERY_SQL = f"SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM ({ngram_join._query_sql(4, 80)})"
