"""Mixing sources to target weights, by blocks, multinomial draws and index permutations.

1. Each source's documents, in a pseudorandom order, form one stream of words,
   cut into blocks of ``block_words``.
2. Every output shard of ``shard_slots`` slots draws how many slots each source
   gets: a multinomial draw, one categorical draw per slot.  What a source drew
   beyond its quota over all shards goes to the sources that drew too little,
   so quotas are met exactly and no block is taken more than ``max_repeats``
   times.
3. A source's slots are numbered across shards; number ``j`` is block
   ``permutation(j mod blocks)`` of its pass ``j div blocks``, a keyed Feistel
   permutation per source and pass, so no list of blocks is ever shuffled.
4. Blocks join the pieces of documents inside them by source and block number.

Only functions of Spark run.  The driver sees one row per source (the plan of
the mix), nothing per document or block.  Streams are numbered by two-level
running sums over hash chunks, so a source with a third of all rows is spread.

Defined results: a null text has no words; a document without words is never
taken and has ``taken`` 0.  A null source is a source of its own, ordered last.
Null ids and repeated rows are rows like others, taken independently.  An empty
table gives an empty result.  All draws are functions of ``seed`` and the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import packed, word_count, words_array
from lakemart.sources.paths import scratch_path

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 256
SHARD_SLOTS = 1024
#: Documents per hash chunk of a running sum.
_CHUNK_ROWS = 20_000
_ROUNDS = 4
#: Enough walks for any domain: below 33 * 33 no cycle outside is longer, above a longer one is beyond odds.
_WALKS = 64


@dataclass(frozen=True)
class SourcePlan:
    number: int
    name: str | None
    size: int
    target: float
    blocks: int
    slots: int


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, max_repeats: int) -> list[float]:
    """Shares of ``total`` by weight; what exceeds ``max_repeats`` times a size is shared again by weight."""
    result = [0.0] * len(sizes)
    free = list(range(len(sizes)))
    while free:
        left = total - sum(result[i] for i in range(len(sizes)) if i not in free)
        level = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * level > max_repeats * sizes[i]]
        if not full:
            for i in free:
                result[i] = weights[i] * level
            break
        for i in full:
            result[i] = float(max_repeats * sizes[i])
        free = [i for i in free if i not in full]
    return result


def plan(sizes: DataFrame, weights: Sequence[float], share: float, max_repeats: int, block_words: int) -> list[SourcePlan]:
    """One entry per source in code point order, null last."""
    rows = sizes.groupBy("source").agg(F.sum("size").alias("size")).orderBy(F.col("source").asc_nulls_last()).collect()
    amounts = [r["size"] for r in rows]
    each = [weights[i % len(weights)] for i in range(len(rows))]
    wanted = targets(amounts, each, share * sum(amounts), max_repeats)
    result = []
    for i, (row, target) in enumerate(zip(rows, wanted, strict=True)):
        blocks = -(-row["size"] // block_words)
        slots = min(max_repeats * blocks, round(target * blocks / row["size"])) if row["size"] else 0
        result.append(SourcePlan(i, row["source"], row["size"], target, blocks, slots))
    return result


def permuted(index: Column, n: Column, key: Column) -> Column:
    """Place of ``index`` under a pseudorandom permutation of ``0 .. n - 1`` chosen by ``key``.

    A Feistel network over the square of side ``ceil(sqrt(n))``; values outside
    walk on until they fall inside.
    """
    side = F.ceil(F.sqrt(n.cast("double"))).cast("long")

    def network(value: Column) -> Column:
        start = F.struct(F.call_function("div", value, side).alias("a"), F.pmod(value, side).cast("long").alias("b"))
        return F.aggregate(
            F.array(*[F.lit(i) for i in range(_ROUNDS)]),
            start,
            lambda at, turn: F.struct(
                at["b"].alias("a"), F.pmod(at["a"] + F.pmod(F.xxhash64(at["b"], turn, key), side), side).cast("long").alias("b")
            ),
            lambda at: at["a"] * side + at["b"],
        )

    walks = F.sequence(F.lit(1), F.lit(_WALKS))
    return F.aggregate(walks, network(index.cast("long")), lambda value, _: F.when(value < n, value).otherwise(network(value)))


def _lookup(values: Sequence, at: Column, kind: str) -> Column:
    """Value of a driver-side list, one entry per source, by source number."""
    return F.get(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), at)


def _number_of(bounds: Sequence[int], value: Column) -> Column:
    """How many of the increasing ``bounds`` are at most ``value``."""
    listed = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    return F.size(F.filter(listed, lambda bound: bound <= value))


def _running(values: Sequence[int]) -> list[int]:
    total, result = 0, []
    for value in values:
        total += value
        result.append(total)
    return result


def _draws(sizes: DataFrame, sources: list[SourcePlan], shard_slots: int, seed: int) -> DataFrame:
    """Steps 2 and 3: ``(shard, slot, number, pass, block)`` for every output slot."""
    spark = sizes.sparkSession
    quotas = [s.slots for s in sources]
    total = sum(quotas)
    slots = spark.range(total).select(
        F.floor(F.col("id") / shard_slots).cast("long").alias("shard"),
        F.pmod("id", F.lit(shard_slots)).alias("slot"),
        F.pmod(F.xxhash64(F.lit(f"draw {seed}"), "id"), F.lit(total)).alias("point"),
    )
    drawn = slots.withColumn("number", _number_of(_running(quotas), F.col("point"))).drop("point")
    path = scratch_path(spark, "shard-counts")
    drawn.groupBy("shard", "number").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    counts = spark.read.parquet(path)
    before = counts.select(
        "shard", "number", F.expr("sum(n) OVER (PARTITION BY number ORDER BY shard) - n").alias("before")
    )
    numbered = drawn.withColumn("place", F.expr("row_number() OVER (PARTITION BY shard, number ORDER BY slot) - 1"))
    numbered = numbered.join(before, ["shard", "number"]).withColumn("j", F.col("before") + F.col("place"))
    got = {r["number"]: r["n"] for r in counts.groupBy("number").agg(F.sum("n").alias("n")).collect()}
    taken = [got.get(i, 0) for i in range(len(sources))]
    surplus = _running([max(0, t - q) for t, q in zip(taken, quotas, strict=True)])
    lacking = [max(0, q - t) for t, q in zip(taken, quotas, strict=True)]
    lacks = _running(lacking)
    over = F.col("j") >= _lookup(quotas, F.col("number"), "bigint")
    rank = F.col("j") - _lookup(quotas, F.col("number"), "bigint") + _lookup([0, *surplus[:-1]], F.col("number"), "bigint")
    moved = numbered.withColumn("rank", F.when(over, rank)).withColumn(
        "to", F.when(F.col("rank").isNotNull(), _number_of(lacks, F.col("rank"))).otherwise(F.col("number"))
    )
    moved = moved.withColumn(
        "j",
        F.when(
            F.col("rank").isNotNull(),
            F.col("rank") - _lookup([0, *lacks[:-1]], F.col("to"), "bigint") + _lookup(taken, F.col("to"), "bigint"),
        ).otherwise(F.col("j")),
    )
    blocks = _lookup([max(1, s.blocks) for s in sources], F.col("to"), "bigint")
    placed = moved.select("shard", "slot", F.col("to").alias("number"), "j", blocks.alias("blocks")).select(
        "shard", "slot", "number", F.floor(F.col("j") / F.col("blocks")).cast("long").alias("pass"), F.pmod("j", "blocks").alias("index"), "blocks"
    )
    key = F.xxhash64(F.lit(f"permutation {seed}"), "number", "pass")
    return placed.select("shard", "slot", "number", "pass", permuted(F.col("index"), F.col("blocks"), key).alias("block"))


def _pieces(sizes: DataFrame, sources: list[SourcePlan], block_words: int, seed: int) -> DataFrame:
    """Step 1: ``(number, block, row_no, from_word, n_words)``, one row per document and block that meet."""
    order = F.xxhash64(F.lit(f"stream {seed}"), "doc_id", "content")
    chunks = max(1, -(-sizes.count() // _CHUNK_ROWS))
    names = [s for s in sources if s.name is not None]
    number = F.when(F.col("source").isNull(), F.lit(len(sources) - 1))
    if names:
        known = F.create_map(*[x for s in names for x in (F.lit(s.name), F.lit(s.number))])
        number = number.otherwise(F.element_at(known, F.col("source")))
    rows = sizes.filter("size > 0").select(number.cast("int").alias("number"), "row_no", "size", "doc_id", "content", order.alias("at"))
    rows = rows.withColumn("chunk", F.pmod("at", F.lit(chunks)))
    totals = rows.groupBy("number", "chunk").agg(F.sum("size").alias("n"))
    totals = totals.select("number", "chunk", F.expr("sum(n) OVER (PARTITION BY number ORDER BY chunk) - n").alias("chunk_start"))
    inside = F.expr("sum(size) OVER (PARTITION BY number, chunk ORDER BY at, doc_id, content, row_no ROWS UNBOUNDED PRECEDING) - size")
    placed = rows.withColumn("inside", inside).join(totals, ["number", "chunk"]).withColumn("start", F.col("chunk_start") + F.col("inside"))
    first = F.floor(F.col("start") / block_words)
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    cut = placed.select("number", "row_no", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return cut.select("number", "block", "row_no", (begin - F.col("start")).alias("from_word"), (end - begin).alias("n_words"))


def _sizes(rows: DataFrame) -> DataFrame:
    """Written table of ``doc_id, source, size, content, row_no``."""
    path = scratch_path(rows.sparkSession, "sizes")
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _mix(sizes: DataFrame, weights, share, max_repeats, block_words, shard_slots, seed) -> tuple[list[SourcePlan], DataFrame]:
    sources = plan(sizes, weights, share, max_repeats, block_words)
    if not sum(s.slots for s in sources):
        empty = sizes.filter("false").select(
            *[F.lit(0).cast("long").alias(n) for n in ("shard", "slot", "pass", "block")], "row_no", *[F.lit(0).cast("long").alias(n) for n in ("from_word", "n_words")]
        )
        return sources, empty
    draws = _draws(sizes, sources, shard_slots, seed)
    return sources, draws.join(_pieces(sizes, sources, block_words, seed), ["number", "block"]).drop("number")


def mix_report(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    max_repeats: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 1,
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``; also its ``source``."""
    content = F.xxhash64(F.coalesce("text", F.lit("")))
    sizes = _sizes(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), content.alias("content"), F.monotonically_increasing_id().alias("row_no"))
    )
    sources, blocks = _mix(sizes, weights, share, max_repeats, block_words, shard_slots, seed)
    taken = blocks.groupBy("row_no").agg(F.sum("n_words").alias("taken"))
    spark = docs.sparkSession
    known = spark.createDataFrame([(s.name, s.size, s.target) for s in sources], "source string, source_size long, target double")
    return (
        sizes.withColumnRenamed("source", "own")
        .join(F.broadcast(known), F.col("own").eqNullSafe(F.col("source")))  # the plan: one row per source
        .join(taken, "row_no", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), F.col("own").alias("source"))
    )


def mix_documents(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    max_repeats: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 1,
) -> DataFrame:
    """The mix as documents with the columns of ``docs``.

    One row per document, pass and unbroken run of its taken blocks.  A run that
    is the whole document keeps its text, else the run's words are joined by one
    space; ``n_chars``, where there is one, follows the text.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "documents")
    packed(
        docs,
        F.col("doc_id"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("content"),
        F.monotonically_increasing_id().alias("row_no"),
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    _, blocks = _mix(stored.drop("row"), weights, share, max_repeats, block_words, shard_slots, seed)
    runs = (
        blocks.select("row_no", "pass", "from_word", "n_words", F.expr("block - row_number() OVER (PARTITION BY row_no, pass ORDER BY block)").alias("run"))
        .groupBy("row_no", "pass", "run")
        .agg(F.min("from_word").cast("int").alias("from_word"), F.sum("n_words").cast("int").alias("n_words"))
    )
    text = F.when(F.col("size") == F.col("n_words"), F.col("row.text")).otherwise(
        F.array_join(F.slice(words_array(F.col("row.text")), F.col("from_word") + 1, F.col("n_words")), " ")
    )
    mixed = stored.join(runs, "row_no").withColumn("mixed_text", text)
    changed = {"text": F.col("mixed_text"), "n_chars": F.length("mixed_text").cast("long")}
    return mixed.select(*[changed.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns])


def shard_table(docs: DataFrame, seed: int = 1, **options) -> DataFrame:
    """Where each output slot's words come from: ``shard, slot, doc_id, source, pass, from_word, n_words``."""
    content = F.xxhash64(F.coalesce("text", F.lit("")))
    sizes = _sizes(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), content.alias("content"), F.monotonically_increasing_id().alias("row_no"))
    )
    settings = {"weights": WEIGHTS, "share": 1.5, "max_repeats": 2, "block_words": BLOCK_WORDS, "shard_slots": SHARD_SLOTS, **options}
    _, blocks = _mix(sizes, seed=seed, **settings)
    return blocks.join(sizes.select("row_no", "doc_id", "source"), "row_no").select(
        "shard", "slot", "doc_id", "source", "pass", "from_word", "n_words"
    )
