"""Rows of a stored table by their place in its files: which rows a choice keeps is a bit per row, not a row that is shuffled."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.scratch import freed_shuffles, scratch_path

#: Number of a row of a stored table, the same in every scan: its file above 36 bits of its row in the file.
ROW_PLACE = "_row_place"
_WRITER = "_writer"
_ROW_BITS = 36
#: How scratch tables are written: small, and one file per task.
SCRATCH = {"compression": "zstd", "maxRecordsPerFile": 0}
#: Rows that one part of a job shuffles; parts run one after the other, so that the shuffle files of one lie on disk at a time.
PART_ROWS = 1 << 25
#: Rows of a table whose choices are broadcast, a bit each and 128 MB at most.
PLACED_ROWS = 1 << 30


def n_parts(n_rows: int) -> int:
    """Parts of a job that shuffles so many rows."""
    return max(1, -(-n_rows // PART_ROWS))


def in_part(keys: Sequence[str | Column], part: int, parts: int) -> Column:
    """Whether the keys are of this part; NULL keys are of one, too."""
    return F.lit(True) if parts == 1 else F.pmod(F.xxhash64(*keys), F.lit(parts)) == part


def stored(frames: DataFrame | Iterable[DataFrame], name: str) -> DataFrame:
    """The rows of one or several frames from the scratch folder; written one after the other, each frees its shuffle files."""
    path = None
    for frame in [frames] if isinstance(frames, DataFrame) else frames:
        spark = frame.sparkSession
        path = path or scratch_path(spark, name)
        with freed_shuffles(spark):
            frame.write.mode("append").options(**SCRATCH).parquet(path)
    return spark.read.parquet(path)


def with_writer(df: DataFrame, part: int = 0) -> DataFrame:
    """``df`` with the number of the task that writes it, which writes one file; ``part`` is another number for each write to a table."""
    return df.withColumn(_WRITER, F.lit(part << 20) + F.spark_partition_id())


def with_place(table: DataFrame) -> DataFrame:
    """A stored table, written :func:`with_writer` and just read, with ``ROW_PLACE``."""
    place = F.shiftleft(F.col(_WRITER).cast("bigint"), _ROW_BITS) + F.col("_metadata.row_index")
    return table.withColumn(ROW_PLACE, place).drop(_WRITER)


def placed(frames: DataFrame | Iterable[DataFrame], name: str) -> DataFrame:
    """:func:`stored` rows with ``ROW_PLACE``."""
    frames = [frames] if isinstance(frames, DataFrame) else frames
    return with_place(stored((with_writer(frame, part) for part, frame in enumerate(frames)), name))


def _place(bits: int, mask: int = -1) -> Column:
    return F.shiftrightunsigned(ROW_PLACE, bits).bitwiseAND(F.lit(mask).cast("bigint"))


def marks(places: DataFrame | Iterable[DataFrame]) -> DataFrame:
    """The rows at ``ROW_PLACE`` as 64 words of a bit per row, for every 4096 rows of a file of which one is named."""
    found = []
    bit = F.expr(f"shiftleft(1L, cast(`{ROW_PLACE}` & 63 as int))")
    for some in [places] if isinstance(places, DataFrame) else places:
        words = some.groupBy(_place(12).alias("_block"), _place(6, 63).cast("int").alias("_word")).agg(F.bit_or(bit).alias("_bits"))
        found.append(stored(words, "marks"))
    words = found[0]
    for more in found[1:]:
        words = words.unionAll(more)
    words = words.groupBy("_block", "_word").agg(F.bit_or("_bits").alias("_bits"))
    whole = words.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_words"))
    every = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("_words", i), F.lit(0).cast("bigint")))
    return stored(whole.select("_block", every.alias("_words")), "marked")


def marked(df: DataFrame, of: DataFrame) -> DataFrame:
    """The rows of ``df``, which has ``ROW_PLACE``, that the marks name; no row is shuffled."""
    met = df.join(F.broadcast(of), _place(12) == F.col("_block"))
    bits = F.get("_words", _place(6, 63).cast("int"))
    named = F.expr(f"cast(`{ROW_PLACE}` & 63 as int)")
    return met.filter(F.call_function("bit_get", bits, named) == 1).select(*[F.col(f"`{c}`") for c in df.columns])
