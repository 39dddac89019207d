"""Column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.sources.paths import scratch_path

#: A word is a run of characters other than space and the control characters tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_array(text: Column) -> Column:
    """Words of a text that is not null, in order."""
    return F.filter(F.split(text, SPACES), lambda word: word != "")


def word_count(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(docs: DataFrame, *columns: Column) -> DataFrame:
    """The whole row as one struct ``row`` beside ``columns``, so that no name of the caller can clash."""
    return docs.select(F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row"), *columns)


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def stored(frame: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """The rows, written to the shared scratch folder and read from there.

    A ``narrow`` table, a few numbers per row, is written by an eighth of the
    shuffle partitions: as many files as partitions would be very many small
    ones, and every file that a task opens costs it a process on some stores.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    if narrow:
        frame = frame.coalesce(max(12, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    frame.write.parquet(path)
    return spark.read.parquet(path)


def salted_join(left: DataFrame, right: DataFrame, key: str, salt: Column, how: str, salts: int = 16) -> DataFrame:
    """Equi-join on ``key`` where ``left`` may repeat a key without bound and ``right`` holds it once.

    ``salt`` (a hash of other columns of ``left``) deals a heavy key over
    ``salts`` tasks; each row of ``right`` is sent to all of them.
    """
    spread = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = left.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    return dealt.join(spread, [key, "_salt"], how).drop("_salt")
