"""One query per operator over its whole table, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import (
    exact_dedup,
    manifest,
    mixing,
    ngram_join,
    odd_sketch,
    packing,
    pii,
    quality_rules,
    substring_dedup,
    token_counts,
    token_files,
    vector_codes,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return operator(spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet"))

    return run


QUERIES: dict[str, Query] = {
    "op1_mixing": _table("documents", mixing.mix_report),
    "op2_ngram_join": _table("documents", lambda docs: ngram_join.near_duplicates(docs, k=3, percent=90)),
    "op3_warc": _table("pages", warc.archive_report),
    "op4_exact_dedup": _table("documents", exact_dedup.dedup_decisions),
    "op5_packing": _table("documents", packing.pack_report),
    "op6_token_counts": _table("documents", token_counts.token_count_report),
    "op7_substring_dedup": _table("documents", substring_dedup.repeat_report),
    "op8_quality_rules": _table("documents", quality_rules.quality_report),
    "op9_token_files": _table("documents", token_files.token_file_report),
    "op10_pii": _table("documents", pii.pseudonym_report),
    "op11_vector_codes": _table("embeddings", vector_codes.code_report),
    "op12_manifest": _table("documents", manifest.proof_report),
    "op13_odd_sketch": _table("documents", lambda docs: odd_sketch.near_duplicates(docs, k=4, percent=80)),
}

SQL: dict[str, str] = {
    "op2_ngram_join": ngram_join.QUERY_SQL,
    "op3_warc": warc.QUERY_SQL,
    "op4_exact_dedup": exact_dedup.QUERY_SQL,
    "op7_substring_dedup": substring_dedup.QUERY_SQL,
    "op8_quality_rules": quality_rules.QUERY_SQL,
    "op11_vector_codes": vector_codes.QUERY_SQL,
    "op12_manifest": manifest.QUERY_SQL,
    "op13_odd_sketch": odd_sketch.QUERY_SQL,
}
