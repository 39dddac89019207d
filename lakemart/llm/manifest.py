"""Merkle manifest of a dataset: a leaf per document, a subtree per group, one root, and an inclusion proof per document.

``H`` is the lower-case hex SHA-256 of its inputs, concatenated; digests enter as
hex text.  A leaf is H of the fields, each ``-`` if null, else its UTF-8 byte
count, a colon and its value.  In a group leaves ascend by document id; while
several nodes remain, every two consecutive ones become their H, a last one alone
its own.  The subroots, in order of their groups, make the root in the same way.

Where a leaf stands is found by rank in bitmaps, not by sorting documents:

1. Tasks set a bit per document id in 64-bit words, keyed by group and
   ``id >> 6``; words of tasks merge by OR and count their documents.  Words
   without a document are not stored, so that sparse ids cost a word each.
2. A directory holds the documents before each word: words add up inside blocks
   of 1024 words, blocks by a running total over ranges of blocks.
3. A document's place is the word's count plus the bits below its own.  Where a
   word counts more documents than bits (ids that repeat, or are null), the
   documents of that word alone are ranked by range, ties by leaf.

Levels are reduced in slot arrays: nodes are keyed by group and ``place >> 10``,
put into an array by the remaining bits, and 10 levels become one node.  Arrays
hold 1024 nodes at most, whatever a group's size.  Proofs come down the same way:
an array gets the siblings above it in one row and adds its own.

Only ids, digests and group names are shuffled, never texts.

Defined results: rows with equal ids are ordered by their leaf; null ids come
last in their group; a null group comes first, the others follow by UTF-8 bytes.
Repeated rows are leaves of their own.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import salted_join
from lakemart.sources.paths import scratch_path

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one slot array reduces.
LEVELS = 10
#: Words per block of the directory, as a power of two.
_BLOCK = 10
#: Word of documents without an id, above every other.
_NO_ID = 1 << 60
_SALTS = 4


def _stored(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def field(value: Column) -> Column:
    """A field as it enters a leaf."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _group_key(group: Column) -> Column:
    """Text that is never null and sorts null first."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


# --- places by rank -----------------------------------------------------------------------------


def _running(value: str):
    """Adds ``task`` and ``before``, the total of ``value`` in the task's earlier rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            sums = np.cumsum(batch.column(value).to_numpy())
            before = np.concatenate([[0], sums[:-1]])[: batch.num_rows] + total
            total += int(sums[-1]) if batch.num_rows else 0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, task)), pa.array(before.astype(np.int64))],
                names=[*batch.schema.names, "task", "before"],
            )

    return run


def running_total(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``rows`` and ``before``: the total of the long ``value`` over all rows earlier in the order of ``keys``.

    Ranges of keys go to tasks; the driver adds up one number per task.
    """
    spark = rows.sparkSession
    tasks = _tasks(spark)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    dealt = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    ranged = _stored(dealt.mapInArrow(_running(value), f"{schema}, task long, before long"), "ranges")
    sums = dict(ranged.groupBy("task").agg(F.sum(value)).collect())  # a row per task
    starts, total = [], 0
    for task in sorted(sums):
        starts.append((task, total))
        total += sums[task]
    offsets = spark.createDataFrame(starts, "task long, start long")
    return ranged.join(F.broadcast(offsets), "task").withColumn("before", F.col("before") + F.col("start")).drop("task", "start")


def _since_first(rows: DataFrame, keys: list[str], value: str = "before") -> DataFrame:
    """``value`` less its smallest in the rows of the same ``keys``."""
    named = rows.withColumn("_keys", F.struct(*keys))
    least = named.groupBy("_keys").agg(F.min(value).alias("_least"))
    joined = salted_join(named, least, "_keys", F.xxhash64(value), "inner", _SALTS)
    return joined.withColumn(value, F.col(value) - F.col("_least")).drop("_keys", "_least")


def _words(leaves: DataFrame) -> DataFrame:
    """The bitmaps with their directory: ``grp, word, bits, n, base``, ``base`` being the documents of the group before the word."""
    bit = F.expr("coalesce(shiftleft(1L, cast(doc_id & 63 as int)), 0L)")
    bitmaps = _stored(
        leaves.groupBy("grp", "word").agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n")).withColumn("block", F.shiftright("word", _BLOCK)),
        "bitmaps",
    )
    blocks = bitmaps.groupBy("grp", "block").agg(F.sum("n").alias("n"))
    directory = _since_first(running_total(blocks, ["grp", "block"], "n"), ["grp"]).select("grp", "block", "before")
    inside = F.expr("sum(n) OVER (PARTITION BY grp, block ORDER BY word) - n")
    return bitmaps.withColumn("inside", inside).join(directory, ["grp", "block"]).select("grp", "word", "bits", "n", (F.col("before") + F.col("inside")).alias("base"))


def with_places(leaves: DataFrame) -> DataFrame:
    """Stored ``leaves`` with ``place``, the rank of the document in its group, from 0.

    Takes ``grp, doc_id, word, leaf`` and ``row_no``, unique, and returns all columns.
    """
    key = F.struct("grp", "word")
    words = _words(leaves).select(key.alias("at"), "bits", "n", "base")
    looked_up = salted_join(leaves.withColumn("at", key), words, "at", F.xxhash64("row_no"), "inner", _SALTS).drop("at")
    below = F.expr("bits & ~shiftleft(-1L, cast(doc_id & 63 as int))")
    single = F.col("n") == F.bit_count("bits")
    looked_up = _stored(looked_up.withColumn("single", single).withColumn("place", F.when(single, F.col("base") + F.bit_count(below))), "ranked")
    names = [*leaves.columns, "place"]
    ranked = looked_up.filter("single").select(*names)
    crowded = looked_up.filter("NOT single")
    if crowded.isEmpty():
        return ranked
    crowded = crowded.drop("place", "bits", "n", "single").withColumn("one", F.lit(1).cast("long")).withColumn("no_id", F.col("doc_id").isNull())
    ordered = running_total(crowded, ["grp", "no_id", "doc_id", "leaf", "row_no"], "one")
    placed = _since_first(ordered, ["grp", "word"]).withColumn("place", F.col("base") + F.col("before"))
    return ranked.unionAll(placed.select(*names))


# --- levels by slot arrays ----------------------------------------------------------------------


def _h(*digests: bytes) -> bytes:
    return hashlib.sha256(b"".join(digests)).hexdigest().encode()


def _levels_here(count: int) -> int:
    """Levels that an array reduces in a tree with ``count`` nodes."""
    return min(LEVELS, max(0, count - 1).bit_length())


def _reduced(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """Nodes of every level, the given ones first."""
    every = [nodes]
    for _ in range(levels):
        nodes = [_h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        every.append(nodes)
    return every


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Table]]:
    """Rows of each ``grp, array`` as one table; the input brings them one after the other, 1024 nodes at most."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        groups, arrays = batch.column("grp").to_pylist(), batch.column("array").to_numpy()
        cuts = [0, *(i for i in range(1, batch.num_rows) if arrays[i] != arrays[i - 1] or groups[i] != groups[i - 1]), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            key = (groups[start], int(arrays[start]))
            if held and key != last:
                yield *last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield *last, pa.Table.from_batches(held)


def _slots(table: pa.Table, column: str) -> tuple[list, np.ndarray]:
    """Values of a column by slot, and the slot of every node row."""
    slot = table.column("slot").to_numpy()
    values: list = [None] * int((slot >= 0).sum())
    for at, value in zip(slot.tolist(), table.column(column).to_pylist(), strict=True):
        if at >= 0:
            values[at] = value
    return values, slot


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``grp, place, digest, count``: one node per array, for the next phase."""
    rows = []
    for grp, array, table in _arrays(batches):
        count = table.column("count")[0].as_py()
        nodes, _ = _slots(table, "digest")
        levels = _levels_here(count)
        rows.append((grp, array, _reduced([n.hex().encode() for n in nodes], levels)[-1][0], -(-count // (1 << levels))))
        if len(rows) == 10_000:
            yield _node_rows(rows)
            rows = []
    if rows:
        yield _node_rows(rows)


def _node_rows(rows: list[tuple]) -> pa.RecordBatch:
    grp, place, digest, count = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(grp, pa.string()), pa.array(place, pa.int64()), pa.array([bytes.fromhex(d.decode()) for d in digest], pa.binary()), pa.array(count, pa.int64())],
        names=["grp", "place", "digest", "count"],
    )


def _dealt(nodes: DataFrame) -> DataFrame:
    """Nodes, and any other rows of an array, brought together by array."""
    return nodes.repartition(_tasks(nodes.sparkSession), "grp", "array").sortWithinPartitions("grp", "array")


def _in_arrays(nodes: DataFrame) -> DataFrame:
    return nodes.withColumns({"array": F.shiftright("place", LEVELS), "slot": F.expr(f"cast(place & {(1 << LEVELS) - 1} as int)")})


_NODE = "grp string, place long, digest binary, count long"


def reduced_phases(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """Nodes before each phase and, last, one node per group; ``largest`` is the count of the largest group."""
    phases = [nodes]
    while largest > 1:
        arrays = _in_arrays(phases[-1].select("grp", "place", "digest", "count")).select("grp", "array", "slot", "digest", "count")
        phases.append(_stored(_dealt(arrays).mapInArrow(_up, _NODE), "nodes"))
        largest = -(-largest // (1 << LEVELS))
    return phases


#: A step of a path: which side the sibling is on, then its digest; no sibling, no digest.
_ALONE, _RIGHT, _LEFT = b"\0", b"\1", b"\2"


def _path_below(every: list[list[bytes]], slot: int) -> bytes:
    steps = []
    for nodes in every[:-1]:
        other = slot ^ 1
        if other < len(nodes):
            steps.append((_LEFT if other < slot else _RIGHT) + bytes.fromhex(nodes[other].decode()))
        else:
            steps.append(_ALONE)
        slot >>= 1
    return b"".join(steps)


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``grp, array, path`` for every node of an array, as the row of the array below it."""
    for grp, _, table in _arrays(batches):
        nodes, slot = _slots(table, "digest")
        path = next((p for p in table.column("path").to_pylist() if p is not None), b"")
        every = _reduced([n.hex().encode() for n in nodes], _levels_here(max(c or 0 for c in table.column("count").to_pylist())))
        places = table.column("place").to_pylist()
        at = [(i, int(s)) for i, s in enumerate(slot) if s >= 0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([grp] * len(at), pa.string()), pa.array([places[i] for i, _ in at], pa.int64()), pa.array([_path_below(every, s) + path for _, s in at], pa.binary())],
            names=["grp", "array", "path"],
        )


def paths_down(phases: list[DataFrame], paths: DataFrame) -> DataFrame:
    """``grp, array, path`` for the arrays of the first phase, from ``paths`` of whole groups (their only array is 0)."""
    for nodes in reversed(phases[1:]):
        paths = _stored(_dealt(_with_paths(nodes.select("grp", "place", "digest", "count"), paths)).mapInArrow(_down, "grp string, array long, path binary"), "paths")
    return paths


def _with_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Rows of the nodes' arrays beside one row per array that holds its path, in slot -1."""
    return _in_arrays(nodes).unionByName(paths.withColumn("slot", F.lit(-1)), allowMissingColumns=True)


def folded(digest: bytes, path: bytes) -> tuple[bytes, bytes]:
    """Root from a leaf in hex and its path, and H of the path's siblings."""
    at, siblings = 0, []
    while at < len(path):
        side = path[at : at + 1]
        at += 1
        if side == _ALONE:
            digest = _h(digest)
            continue
        sibling = path[at : at + 32].hex().encode()
        at += 32
        siblings.append(sibling)
        digest = _h(sibling, digest) if side == _LEFT else _h(digest, sibling)
    return digest, _h(*siblings)


def _proofs(root: str):
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per document; the root is the manifest's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, table in _arrays(batches):
            nodes, slot = _slots(table, "digest")
            path_rows = [(p, s) for p, s in zip(table.column("path").to_pylist(), table.column("subroot").to_pylist(), strict=True) if p is not None]
            path, subroot = path_rows[0]
            every = _reduced([n.hex().encode() for n in nodes], _levels_here(max(c or 0 for c in table.column("count").to_pylist())))
            ids, presented = table.column("doc_id").to_pylist(), table.column("presented").to_pylist()
            out = []
            for i, s in enumerate(slot.tolist()):
                if s >= 0:
                    top, proof = folded(presented[i].hex().encode(), _path_below(every, s) + path)
                    out.append((ids[i], nodes[s].hex(), proof.decode(), top.decode()))
            if out:
                doc_id, leaves, proofs, tops = zip(*out, strict=True)
                n = len(out)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_id, pa.int64()),
                        pa.array(leaves, pa.string()),
                        pa.array([subroot] * n, pa.string()),
                        pa.array([root] * n, pa.string()),
                        pa.array(proofs, pa.string()),
                        pa.array(tops, pa.string()),
                        pa.array([t == root for t in tops], pa.bool_()),
                    ],
                    names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    return run


_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


# --- the manifest -------------------------------------------------------------------------------


class Manifest:
    """Stored tables of a manifest: ``leaves`` with places, nodes per phase, ``groups`` with subroots, and ``root``."""

    def __init__(self, leaves: DataFrame) -> None:
        spark = leaves.sparkSession
        placed = with_places(leaves)
        counts = _stored(leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("count")), "groups")
        counted = salted_join(placed, counts, "grp", F.xxhash64("row_no"), "inner", _SALTS)
        nodes = _stored(counted.select("grp", "place", F.unhex("leaf").alias("digest"), "count", "doc_id", F.unhex("presented").alias("presented")), "leaves")
        self.phases = reduced_phases(nodes, counts.agg(F.max("count")).first()[0] or 0)
        subroots = self.phases[-1].select("grp", F.col("digest").alias("subroot"))
        ordered = running_total(counts.select("grp", F.lit(1).cast("long").alias("one")), ["grp"], "one")
        n_groups = counts.count()
        top = subroots.join(ordered, "grp").select(
            F.lit("").alias("grp"), F.col("before").alias("place"), F.col("subroot").alias("digest"), F.lit(n_groups).cast("long").alias("count"), F.col("grp").alias("name")
        )
        top = _stored(top, "top")
        self.top_phases = reduced_phases(top, n_groups)
        last = self.top_phases[-1].select("digest").first()
        self.root = last["digest"].hex() if last else None
        self.spark = spark

    @property
    def subroots(self) -> DataFrame:
        return self.top_phases[0].select(F.col("name").alias("grp"), F.lower(F.hex("digest")).alias("subroot"))

    def proofs(self) -> DataFrame:
        """One row per document: proof, and the root folded from the leaf as presented."""
        if self.root is None:
            return self.spark.createDataFrame([], _PROOF)
        start = self.spark.createDataFrame([("", 0, b"")], "grp string, array long, path binary")
        by_place = self._top_paths(start)
        paths = paths_down(self.phases, by_place.select("grp", "array", "path"))
        paths = salted_join(paths, self.subroots, "grp", F.xxhash64("array"), "inner", _SALTS)
        return _dealt(_with_paths(self.phases[0], paths)).mapInArrow(_proofs(self.root), _PROOF)

    def _top_paths(self, start: DataFrame) -> DataFrame:
        """``grp, array, path`` of every group, its siblings among the subroots."""
        top = self.top_phases[0].select("grp", "place", "digest", "count")
        above = paths_down(self.top_phases, start)
        by_place = _stored(_dealt(_with_paths(top, above)).mapInArrow(_down, "grp string, array long, path binary"), "top-paths")
        names = self.top_phases[0].select("name", F.col("place").alias("array"))
        return by_place.select("array", "path").join(names, "array").select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("array"), "path")


def build(docs: DataFrame, group: str = "lang", doc_id: str = "doc_id", fields: tuple[str, ...] = FIELDS, presented: dict[str, Column] | None = None) -> Manifest:
    """Manifest of all rows; ``presented`` replaces fields in the copy of a document that is held against it."""
    given = {name: F.col(f"`{name}`") for name in fields}
    other = {**given, **(presented or {})}
    same = F.lit(True)
    for name in presented or {}:
        same = same & given[name].eqNullSafe(other[name])
    own = leaf(*given.values())
    identity = F.col(f"`{doc_id}`").cast("long")
    rows = docs.select(
        _group_key(F.col(f"`{group}`")).alias("grp"),
        identity.alias("doc_id"),
        own.alias("leaf"),
        F.when(~same, leaf(*other.values())).alias("presented"),
        F.coalesce(F.shiftright(identity, 6), F.lit(_NO_ID)).alias("word"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    return Manifest(_stored(rows.withColumn("presented", F.coalesce("presented", "leaf")), "leaf-rows"))


def proof_report(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, where every seventh by checksum is presented with one character more than it had."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return build(docs, presented={"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}).proofs()


def _query_sql() -> str:
    """Level by level in DuckDB; the checksum is computed bit by bit."""

    def enc(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR END"

    def leaf_sql(n_chars: str) -> str:
        return "sha256(" + " || ".join(enc(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"

    return f"""
  WITH RECURSIVE d AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(doc_id::VARCHAR) * 9), lambda i:
        CASE WHEN i % 9 = 0 THEN 1000 + ascii(substr(doc_id::VARCHAR, (i // 9 + 1)::INT, 1)) ELSE 0 END::BIGINT)),
      lambda a, b: CASE WHEN b > 0 THEN xor(a, b - 1000) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 7 = 0 AS tampered
    FROM documents
  ), f AS MATERIALIZED (
    SELECT doc_id, lang, {leaf_sql("n_chars")} AS leaf, {leaf_sql("(CASE WHEN tampered THEN n_chars + 1 ELSE n_chars END)")} AS presented FROM d
  ), l AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM f
  ), t AS (
    SELECT lang, 0 AS level, place, leaf AS h, n FROM l
    UNION ALL
    SELECT lang, any_value(level) + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), any_value((n + 1) // 2)
    FROM t WHERE n > 1 GROUP BY lang, place // 2
  ), tree AS MATERIALIZED (SELECT * FROM t),
  s AS MATERIALIZED (
    SELECT lang, h AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1
  ), u AS (
    SELECT 0 AS level, place, subroot AS h, n FROM s
    UNION ALL
    SELECT any_value(level) + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), any_value((n + 1) // 2)
    FROM u WHERE n > 1 GROUP BY place // 2
  ), top AS MATERIALIZED (SELECT * FROM u),
  levels AS (
    SELECT l.lang, l.place, r.v AS level, (l.place >> r.v) & 1 AS side, x.h AS h
    FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang JOIN range(64) r(v) ON r.v < s.height
    LEFT JOIN tree x ON x.lang IS NOT DISTINCT FROM l.lang AND x.level = r.v AND x.place = xor(l.place >> r.v, 1)
    UNION ALL
    SELECT l.lang, l.place, s.height + r.v, (s.place >> r.v) & 1, x.h
    FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang JOIN range(64) r(v) ON r.v < (SELECT max(level) FROM top)
    LEFT JOIN top x ON x.level = r.v AND x.place = xor(s.place >> r.v, 1)
  ), paths AS MATERIALIZED (
    SELECT lang, place, list({{'side': side, 'h': h}} ORDER BY level) AS path FROM levels GROUP BY lang, place
  ), g AS (
    SELECT l.doc_id, l.leaf, l.presented, l.lang, coalesce(p.path, []) AS path
    FROM l LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.place = l.place
  )
  SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(list_filter(path, lambda x: x.h IS NOT NULL), lambda x: x.h), '')) AS proof_sha256,
    folded_root, folded_root = root AS verified
  FROM (
    SELECT g.doc_id, g.leaf, g.path, s.subroot, (SELECT h FROM top WHERE n = 1) AS root,
      list_reduce(list_prepend({{'side': 0::BIGINT, 'h': g.presented}}, g.path), lambda a, b: {{'side': 0::BIGINT, 'h':
        sha256(CASE WHEN b.h IS NULL THEN a.h WHEN b.side = 1 THEN b.h || a.h ELSE a.h || b.h END)}}).h AS folded_root
    FROM g JOIN s ON g.lang IS NOT DISTINCT FROM s.lang
  )
"""


QUERY_SQL = _query_sql()
