"""Existence joins on keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.filters import present
from lakemart.operators.places import in_part, n_parts

_SLICE = "_slice"
#: Bits of a key filter; 64-bit words, so that at most 4 million rows of 16 bytes are ever broadcast.
FILTER_BITS = 1 << 28
#: Rows of a key side that is broadcast whole.
FEW_ROWS = 1_000_000


def _key_side(other: DataFrame, keys: Sequence[str], unique: bool, slices: int) -> DataFrame:
    """Only the key columns, without NULL; at most ``slices`` rows per key when they may repeat.

    Repeats collapse before the shuffle.  What comes out is rebalanced: were it
    still partitioned by the join keys, as after an aggregate or a window over
    them, the join would take that partitioning over, and adaptive execution
    could not split a heavy key of the other side.
    """
    side = other.filter(present(*keys)).select(*keys)
    if unique:
        return side
    return side.withColumn(_SLICE, F.spark_partition_id() % slices).distinct().drop(_SLICE).hint("rebalance")


def few_keys(parent: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the key side of ``parent`` can be broadcast; counted."""
    return parent.filter(present(*keys)).count() <= FEW_ROWS


def keep_known_by_few(df: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`keep_known` for a parent of :func:`few_keys`: no row of ``df`` is shuffled, however often a key occurs."""
    return _join(df, F.broadcast(parent.filter(present(*keys)).select(*keys).distinct()), keys, "left_semi")


def _join(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join by name; the columns stay in their order."""
    return df.join(side, list(keys), how).select(*[F.col(f"`{c}`") for c in df.columns])


def keep_known(
    df: DataFrame, parent: DataFrame, keys: Sequence[str], parent_unique: bool = False, slices: int = 32
) -> DataFrame:
    """Rows whose keys exist in ``parent``.

    Broadcast or shuffle is left to Spark, which goes by the measured size of
    ``parent``.  Say ``parent_unique=True`` only for a stored table with one
    row per key; it spares the collapse of repeats, which leaves at most
    ``slices`` rows per key.
    """
    return _join(df, _key_side(parent, keys, parent_unique, slices), keys, "left_semi")


def keep_known_in_parts(df: DataFrame, parent: DataFrame, keys: Sequence[str]) -> Iterator[DataFrame]:
    """:func:`keep_known` as frames, each of the keys of one part on both sides, which are joined one after the other."""
    parts = n_parts(df.count() + parent.count())
    for part in range(parts):
        ours = in_part(keys, part, parts)
        yield keep_known(df.filter(ours), parent.select(*keys).filter(ours), keys)


def keep_new(
    df: DataFrame, known: DataFrame, keys: Sequence[str], known_unique: bool = False, slices: int = 32
) -> DataFrame:
    """Rows whose keys do not exist in ``known`` (J3); a NULL key matches nothing and stays."""
    return _join(df, _key_side(known, keys, known_unique, slices), keys, "left_anti")


def _filter_place(keys: Sequence[str]) -> tuple[Column, Column]:
    """Word of a key, and two bits in it."""
    code = F.xxhash64(*keys)
    word = F.shiftrightunsigned(code, 64 - (FILTER_BITS.bit_length() - 7))
    first, second = (F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({', '.join(f'`{k}`' for k in keys)}), {shift}) & 63 as int))") for shift in (0, 6))
    return word, first.bitwiseOR(second)


def key_filter(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bloom filter over the keys as ``word, bits``, words without a bit left out; filters merge by :func:`merged_filter`."""
    word, bits = _filter_place(keys)
    return df.select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def merged_filter(filters: DataFrame) -> DataFrame:
    return filters.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def may_be_known(df: DataFrame, keys: Sequence[str], filter_: DataFrame, name: str) -> DataFrame:
    """``df`` with boolean column ``name``: whether the filter holds the row's key; False is certain."""
    word, bits = _filter_place(keys)
    held = F.broadcast(filter_.withColumnsRenamed({"word": "_word", "bits": "_bits"}))
    joined = df.withColumn("_place", word).join(held, F.col("_place") == F.col("_word"), "left")
    known = F.coalesce(F.col("_bits").bitwiseAND(bits) == bits, F.lit(False))
    return joined.withColumn(name, known).drop("_place", "_word", "_bits")
