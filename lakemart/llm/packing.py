"""Packing by power-of-two decomposition.

A document's ids, end id included, are cut into pieces of ``longest`` and the
binary parts of the rest, larger first.  Every piece is a sequence of its own:
its length is a power of two, so none is padded and none crosses documents.
Pieces of equal length form a bucket: ``bucket`` is the logarithm of the length.
A batch holds pieces of one bucket only, ``BATCH_TOKENS`` ids of them; a task
fills the batches of its buckets in turn, so only its last one of each is short.

Each row is cut where it stands; nothing is shuffled, so no source, text or id
can be hot, and a lost task is simply run again.

Defined results: a null text counts as empty and gives one piece, the end id.
Null ids and repeated rows are packed like others.  An empty table gives an
empty result.  Extra columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.token_ids import KEPT_PIECES, MANY_PIECES, default_tokenizer, encoded

LONGEST = 1024
#: Ids of a full batch.
BATCH_TOKENS = 1 << 16


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """``longest`` as often as it fits, then the binary parts of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << bit for bit in range(longest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def _as_lists(data: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in data])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(data), "<i4")))


def _batched(length: np.ndarray, held: np.ndarray, task: int) -> dict[str, pa.Array]:
    """Bucket and batch of each piece; ``held`` counts the task's pieces by bucket and is carried on."""
    bucket = np.log2(length).astype(np.int64)
    place = np.empty(len(length), dtype=np.int64)
    for b in np.unique(bucket):
        mine = np.flatnonzero(bucket == b)
        place[mine] = held[b] + np.arange(len(mine))
        held[b] += len(mine)
    number = place // np.maximum(1, BATCH_TOKENS // length)
    return {"bucket": pa.array(bucket.astype(np.int32)), "batch": pa.array(task << 38 | bucket << 32 | number)}


def _cut(tokenizer: str, longest: int, lists: bool):
    """Pieces of each document, their ids as binary, or as lists with a checksum of the binary form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        held = np.zeros(longest.bit_length(), dtype=np.int64)
        for batch, ids in encoded(tokenizer, batches, rows=128, kept=KEPT_PIECES if lists else MANY_PIECES):
            row, start, length, total, data = [], [], [], [], []
            for i, whole in enumerate(ids):
                n, at = len(whole) // 4, 0
                for size in piece_lengths(n, longest):
                    row.append(i)
                    start.append(at)
                    length.append(size)
                    total.append(n)
                    data.append(whole[4 * at : 4 * (at + size)])
                    at += size
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "doc_tokens": pa.array(total, pa.int64()),
                **_batched(np.array(length, dtype=np.int64), held, task),
                "ids": _as_lists(data) if lists else pa.array(data, pa.binary()),
            }
            if lists:
                columns["ids_crc32"] = pa.array([zlib.crc32(x) for x in data], pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _pieces(docs: DataFrame, tokenizer: str | None, longest: int, text: str, doc_id: str, lists: bool) -> DataFrame:
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence has to be a power of two")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ids = "ids array<int>, ids_crc32 long" if lists else "ids binary"
    schema = f"doc_id long, start long, length long, doc_tokens long, bucket int, batch long, {ids}"
    pieces = rows.mapInArrow(_cut(tokenizer or default_tokenizer(), longest, lists), schema)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def pack(docs: DataFrame, tokenizer: str | None = None, longest: int = LONGEST, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, bucket, batch, ids, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit numbers as binary.
    """
    return _pieces(docs, tokenizer, longest, text, doc_id, lists=False)


def crc(ids: Column) -> Column:
    return F.crc32(ids).cast("long")


def pack_report(docs: DataFrame) -> DataFrame:
    """One row per piece with a checksum in place of the ids."""
    pieces = pack(docs)
    return pieces.select("doc_id", "start", "length", crc(F.col("ids")).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket", "batch")


def training_sequences(
    docs: DataFrame, tokenizer: str | None = None, longest: int = LONGEST, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """The pieces with ``ids`` as a list of numbers, and ``ids_crc32`` of their binary form."""
    return _pieces(docs, tokenizer, longest, text, doc_id, lists=True)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per bucket, ``bucket=<n>``; readers of one bucket read nothing else."""
    pieces.write.partitionBy("bucket").parquet(path)
