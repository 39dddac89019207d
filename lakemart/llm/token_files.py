"""Token ids in ORC files.

Documents are dealt by ranges of their id, sorted, encoded and written as ORC:
integer run-length encoding for the ids, row indexes for skipping, and Bloom
filters on the document id.  A file holds consecutive documents and each row
its place inside the file, so stripes are read in parallel and the place in the
whole stream is one running sum over files.

Rows are dealt by id, then text hash, then a row number, so neither a repeated
id nor a repeated row gathers in one task.  Spark's writer commits the files.

Defined results: a null text counts as empty, so its document is the end id
alone.  Null ids come first; rows of equal id are ordered by text hash.  An
empty table gives no rows.  Extra columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.token_ids import MANY_PIECES, default_tokenizer, encoded
from lakemart.sources.paths import scratch_path

#: Writer settings: what the format is chosen for.
ORC_OPTIONS = {
    "orc.compress": "SNAPPY",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "10000",
    "orc.stripe.size": str(32 << 20),
}
SCHEMA = "doc_id long, part long, start long, n_tokens long, ids array<int>"


def _encode(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, start = TaskContext.get().partitionId(), 0
        for batch, ids in encoded(tokenizer, batches, kept=MANY_PIECES):
            lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            ends = start + np.cumsum(lengths)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(ids), part, dtype=np.int64)), pa.array(ends - lengths), pa.array(lengths), lists],
                names=["doc_id", "part", "start", "n_tokens", "ids"],
            )
            start = int(ends[-1]) if len(ends) else start

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, partitions: int | None = None, text: str = "text", doc_id: str = "doc_id") -> None:
    """ORC files of ``doc_id, part, start, n_tokens, ids`` in ascending order of the id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumns(
        {"tie": F.xxhash64(F.coalesce("text", F.lit(""))), "row_no": F.monotonically_increasing_id()}
    )
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "doc_id", "tie", "row_no").sortWithinPartitions("doc_id", "tie", "row_no")
    encoded_rows = dealt.select("doc_id", "text").mapInArrow(_encode(tokenizer or default_tokenizer()), SCHEMA)
    encoded_rows.write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the files; ids asked for are looked up by stripe statistics, row indexes and Bloom filters."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        data = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        crcs = [zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), batch.column("start"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crcs, pa.int64())],
            names=["doc_id", "part", "start", "n_tokens", "ids_crc32"],
        )


def token_file_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the files, reads them back: ``doc_id, start, n_tokens, ids_crc32`` over the whole stream."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(docs, path)
    read = read_token_files(spark, path).drop("n_tokens").mapInArrow(_checksums, "doc_id long, part long, start long, n_tokens long, ids_crc32 long")
    sizes = (
        spark.read.schema(SCHEMA).orc(path).groupBy("part").agg(F.max(F.col("start") + F.col("n_tokens")).alias("n"))
    )  # one row per file; the ids are not read
    before = sizes.select("part", F.expr("sum(n) OVER (ORDER BY part) - n").alias("before"))
    return read.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
