"""Token counts from an exact histogram of encoded lengths.

Documents are encoded once and counted by length, end id included.  There are
far fewer lengths than documents, so totals, quantiles and truncated totals for
every context limit are suffix sums over the histogram.  Lengths are summed in
two levels, within ranges of lengths and over the ranges, so no task holds them
all.

Defined results: a null text counts as empty and has one token, the end id.
Null group values form a group.  Ids are not looked at; repeated rows count
each.  An empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.token_ids import MANY_PIECES, default_tokenizer, encoded
from lakemart.sources.paths import scratch_path

RANGE = 1024


def _count(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in encoded(tokenizer, batches, kept=MANY_PIECES):
            lengths = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(1, batch.num_columns)), lengths], names=[*batch.schema.names[1:], "n_tokens"])

    return run


def length_histogram(docs: DataFrame, by: Sequence[str] = (), tokenizer: str | None = None, text: str = "text") -> DataFrame:
    """``n_tokens, n_documents`` per encoded length, within the groups of ``by`` if any.

    A stored table: whatever is asked of it, documents are encoded once.
    """
    groups = [F.col(f"`{name}`").alias(f"group_{i}") for i, name in enumerate(by)]
    rows = docs.select(F.col(f"`{text}`").alias("text"), *groups)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:]]
    counted = rows.mapInArrow(_count(tokenizer or default_tokenizer()), ", ".join([*fields, "n_tokens long"]))
    names = [f"group_{i}" for i in range(len(by))]
    histogram = counted.groupBy(*names, "n_tokens").agg(F.count(F.lit(1)).alias("n_documents"))
    path = scratch_path(docs.sparkSession, "length-histogram")
    histogram.write.parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    return stored.select(*[F.col(n).alias(b) for n, b in zip(names, by, strict=True)], "n_tokens", "n_documents")


def suffix_sums(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Answers for every length ``n_tokens`` taken as the limit.

    ``documents_at_least`` and ``tokens_at_least`` count documents of that
    length or more; ``truncated_total`` is what remains when each document is
    cut to the limit; ``rank`` is the share of documents of at most this length,
    so the ``q`` quantile is the smallest length whose rank reaches ``q``.
    """
    names = [f"group_{i}" for i in range(len(by))]
    rows = histogram.select(*[F.col(f"`{b}`").alias(n) for n, b in zip(names, by, strict=True)], "n_tokens", "n_documents")
    rows = rows.withColumn("range", F.floor(F.col("n_tokens") / RANGE)).withColumn("tokens", F.col("n_tokens") * F.col("n_documents"))
    ranges = rows.groupBy(*names, "range").agg(F.sum("n_documents").alias("range_documents"), F.sum("tokens").alias("range_tokens"))
    group = f"PARTITION BY {', '.join(names)}" if names else ""
    above = f"OVER ({group} ORDER BY range DESC) "
    ranges = ranges.select(
        *names,
        "range",
        F.expr(f"sum(range_documents) {above} - range_documents").alias("above_documents"),
        F.expr(f"sum(range_tokens) {above} - range_tokens").alias("above_tokens"),
        F.expr(f"sum(range_documents) OVER ({group})").alias("all_documents"),
        F.expr(f"sum(range_tokens) OVER ({group})").alias("all_tokens"),
    )
    inside = f"OVER (PARTITION BY {', '.join([*names, 'range'])} ORDER BY n_tokens DESC)"
    rows = rows.select(
        *names,
        "range",
        "n_tokens",
        "n_documents",
        F.expr(f"sum(n_documents) {inside}").alias("inside_documents"),
        F.expr(f"sum(tokens) {inside}").alias("inside_tokens"),
    )
    same: Column = F.col("a.range") == F.col("b.range")
    for name in names:
        same = same & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    joined = rows.alias("a").join(ranges.alias("b"), same)
    documents = F.col("inside_documents") + F.col("above_documents")
    tokens = F.col("inside_tokens") + F.col("above_tokens")
    return joined.select(
        *[F.col(f"a.{n}").alias(b) for n, b in zip(names, by, strict=True)],
        "n_tokens",
        "n_documents",
        documents.alias("documents_at_least"),
        tokens.alias("tokens_at_least"),
        F.col("all_tokens").alias("total_tokens"),
        (F.col("all_tokens") - tokens + F.col("n_tokens") * documents).alias("truncated_total"),
        ((F.col("all_documents") - documents + F.col("n_documents")) / F.col("all_documents")).alias("rank"),
    )


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length whose rank reaches ``q``, null for no documents."""
    return sums.filter(F.col("rank") >= q).agg(F.min("n_tokens").alias("n_tokens"))


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row: tokens left when every document is cut to any ``limit``, null for no documents."""
    return histogram.agg(F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_documents")).alias("n_tokens"))


def token_count_report(docs: DataFrame) -> DataFrame:
    return suffix_sums(length_histogram(docs))
