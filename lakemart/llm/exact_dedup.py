"""Exact deduplication with two passes over a filter of bits.

Pass one sends a few bit numbers per text and keeps the bits that were hit a
second time: a register-blocked Bloom filter of what may repeat.  Pass two
tests every text against it; only rows whose bits were all hit twice are
shuffled and grouped by the SHA-256 of their text, the rest pass straight
through.  False positives cost a shuffle of a few rows and never a wrong
answer, since groups are formed on the SHA-256.

The filter takes ``bits_per_row`` bits per document, so it grows with the
table.  It is broadcast only while its counted size is below
``broadcast_bytes``; beyond, digests alone are joined with it on the filter
word.  Whole rows then meet a second filter, of the digests that were found to
repeat and nothing else, cut into ranges of words that are broadcast one at a
time, a scan each: no text is shuffled that does not repeat, at any size.

Defined results: a null text counts as empty.  Of equal texts the row with the
largest id stays; null ids lose to any id; among rows of the same id exactly
one stays.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import packed, salted_join, stored, text_or_empty, unpacked
from lakemart.sources.paths import scratch_path

PROBES = 3
BITS_PER_ROW = 8
#: Bits of the second filter per digest that repeats.
BITS_PER_REPEAT = 16
BROADCAST_BYTES = 64 << 20
_ENTRY_BYTES = 24


def _word(digest: Column, n_words: int) -> Column:
    """Filter word of a digest."""
    return F.pmod(F.xxhash64(digest), F.lit(n_words))


def _bits(digest: Column) -> Column:
    """The digest's bit numbers inside its word; equal ones are harmless."""
    mixed = F.xxhash64(digest, F.lit("bits"))
    return F.array_distinct(
        F.array(*[F.shiftrightunsigned(mixed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(PROBES)])
    )


def repeat_filter(digests: DataFrame, digest: str, n_words: int) -> DataFrame:
    """Pass one: ``(word, bits)`` where a bit is set when at least two rows hit it."""
    hits = digests.select(_word(F.col(digest), n_words).alias("word"), F.explode(_bits(F.col(digest))).alias("bit"))
    twice = hits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return twice.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def _suspects(rows: DataFrame, digest: str, found: DataFrame, n_words: int, broadcast: bool) -> DataFrame:
    """Pass two: the rows with ``maybe``, true where the filter cannot exclude a repeat.

    Rows that meet a filter too large for a broadcast hold a ``row_no``, which deals those of one text apart.
    """
    mask = F.aggregate(
        _bits(F.col(digest)), F.lit(0).cast("long"), lambda m, bit: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    )
    keyed = rows.withColumns({"_word": _word(F.col(digest), n_words), "_mask": mask})
    side = found.withColumnsRenamed({"word": "_word", "bits": "_bits"})
    joined = (
        keyed.join(F.broadcast(side), "_word", "left")
        if broadcast
        else salted_join(keyed, side, "_word", F.xxhash64("row_no"), "left", 4)
    )
    maybe = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    return joined.withColumn("maybe", maybe).drop("_word", "_mask", "_bits")


def _filter_for(digests: DataFrame, digest: str, bits_per_row: int, broadcast_bytes: int) -> tuple[DataFrame, int, bool]:
    """The written filter, its number of words, and whether its size allows a broadcast."""
    spark = digests.sparkSession
    n_words = max(16, digests.count() * bits_per_row // 64)
    path = scratch_path(spark, "repeat-filter")
    repeat_filter(digests, digest, n_words).write.parquet(path)
    found = spark.read.parquet(path)
    return found, n_words, found.count() * _ENTRY_BYTES <= broadcast_bytes


def _repeats_in_ranges(docs: DataFrame, content: Column, found: DataFrame, n_words: int, broadcast_bytes: int) -> tuple[DataFrame, int, int]:
    """Filter of the digests that repeat, its number of words, and the ranges of words that are each small enough to broadcast.

    Only digests and row numbers are joined and grouped.  A range holds 4 KB at least.
    """
    spark = docs.sparkSession
    digests = stored(docs.select(F.sha2(content, 256).alias("digest"), F.monotonically_increasing_id().alias("row_no")), "digests")
    suspects = _suspects(digests, "digest", found, n_words, False).filter("maybe")
    repeated = suspects.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")
    repeated = stored(repeated, "repeated-digests")
    n_words = max(16, repeated.count() * BITS_PER_REPEAT // 64)
    hits = repeated.select(_word(F.col("digest"), n_words).alias("word"), F.explode(_bits(F.col("digest"))).alias("bit"))
    path = scratch_path(spark, "repeats-filter")
    hits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).write.parquet(path)
    tight = spark.read.parquet(path)
    return tight, n_words, -(-tight.count() * _ENTRY_BYTES // max(broadcast_bytes, 4096)) or 1


def _tested_in_ranges(rows: DataFrame, found: DataFrame, n_words: int, n_ranges: int) -> DataFrame:
    """The rows with ``maybe``, each tested in the one scan whose range of the filter holds its word."""

    def share(word: Column, number: int) -> Column:
        return word.between(n_words * number // n_ranges, n_words * (number + 1) // n_ranges - 1)

    word = _word(F.col("digest"), n_words)
    parts = [
        _suspects(rows.filter(share(word, i)), "digest", found.filter(share(F.col("word"), i)), n_words, True) for i in range(n_ranges)
    ]
    return reduce(DataFrame.unionAll, parts)


def dedup_decisions(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    bits_per_row: int = BITS_PER_ROW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "text-digests")
    docs.select(
        F.col(doc_id).alias("doc_id"),
        F.sha2(text_or_empty(text), 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row_no"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    found, n_words, broadcast = _filter_for(rows, "text_sha256", bits_per_row, broadcast_bytes)
    tested = _suspects(rows, "text_sha256", found, n_words, broadcast)
    suspects = tested.filter("maybe").drop("maybe")
    groups = (
        suspects.groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row_no")).alias("best"))
        .filter("group_size > 1")
    )
    decided = salted_join(suspects, groups, "text_sha256", F.xxhash64("row_no"), "left")
    single = F.col("best").isNull()
    repeated = decided.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("best.row_no") == F.col("row_no"))).alias("kept"),
        "text_sha256",
    )
    alone = tested.filter(~F.col("maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return alone.unionAll(repeated)


def keep_one_copy(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    bits_per_row: int = BITS_PER_ROW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Documents with one row per text, all columns kept.

    Suspect rows are cut to one per text and task before they are shuffled, so
    a text that a third of all rows share stays small.  Rows of the same text
    and id are told apart by a hash of their whole content.
    """
    content = text_or_empty(text)
    found, n_words, broadcast = _filter_for(docs.select(F.sha2(content, 256).alias("digest")), "digest", bits_per_row, broadcast_bytes)
    rows = packed(docs, F.sha2(content, 256).alias("digest"), F.col(doc_id).alias("id"))
    if broadcast:
        tested = _suspects(rows, "digest", found, n_words, True)
    else:
        tested = _tested_in_ranges(rows, *_repeats_in_ranges(docs, content, found, n_words, broadcast_bytes))
    suspects = tested.filter("maybe").withColumn("content", F.xxhash64(F.to_json("row")))
    best = (
        suspects.withColumn(
            "place",
            F.expr("row_number() OVER (PARTITION BY digest ORDER BY id DESC NULLS LAST, content DESC)"),
        )
        .filter("place = 1")
        .select("row")
    )
    return unpacked(tested.filter(~F.col("maybe")).select("row").unionAll(best))


QUERY_SQL = """
  SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
  FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
