"""The newest row per key without shuffling whole rows, documents in compressed files, numbers without failing casts."""

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakemart.functions.cleaning import whole_number
from lakemart.operators import dedup
from lakemart.operators.dedup import keep_latest
from lakemart.operators.keys import keep_known
from lakemart.plans import frontier, silver
from lakemart.schemas import LEDGER
from lakemart.sources import Lake, writers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def crawls(spark):
    """Keys alone, repeated, null, equal in time, in time and path, and in every column."""
    data = [(i, "a", i, "p", f"alone {i}") for i in range(50)]
    data += [(i % 9, "a", 100 + i, "p", f"again {i}") for i in range(40)]
    data += [(None, "a", 1, "p", "null"), (None, "a", 2, "p", "null, newer"), (None, None, 2, "p", "nulls")]
    data += [(60, "a", 5, path, f"path {path}") for path in ("q", "p", None)]
    data += [(61, "a", 5, "p", f"tie {i}") for i in range(4)] + [(61, "a", 4, "p", "older")]
    data += [(62, "a", 5, "p", "equal")] * 3 + [(63, "a", None, "p", "no time"), (63, "a", 1, "q", "time")]
    return spark.createDataFrame(data, "k int, s string, t long, path string, v string")


def test_every_way_chooses_the_same_rows(spark, crawls, monkeypatch):
    known = spark.createDataFrame([("a",)], "s string")
    hashed = crawls.withColumn(dedup.ROW_HASH, dedup.row_hash(crawls))
    for keys, times in ((["k", "s"], ("t", "path")), (["k", "s"], ("t", None)), (["k"], ()), (["k"], ("t", "path"))):
        found = []
        for most in (4_000_000, -1):
            monkeypatch.setattr(dedup, "REPEATED_KEYS", most)
            found += [rows(keep_latest(frame, keys, *times)) for frame in (crawls.repartition(3), hashed.repartition(5))]
        some = crawls.filter("s = 'a'")
        assert all(f == found[0] for f in found) and len(found[0]) == crawls.select(*keys).distinct().count()
        first = keep_latest(crawls, keys, *times, needed=["s"], before=lambda r: keep_known(r, known, ["s"]))
        assert rows(first) == rows(keep_latest(some, keys, *times))


def test_a_row_left_out_before_the_choice_does_not_come_back(spark):
    """Two rows of one key, time and path; only one of them may be chosen."""
    data = spark.createDataFrame([(1, "known", 5, "p", "a"), (1, "unknown", 5, "p", "b")], "k int, s string, t long, path string, v string")
    known = spark.createDataFrame([("known",)], "s string")
    got = keep_latest(data, ["k"], "t", "path", needed=["s"], before=lambda r: keep_known(r, known, ["s"]))
    assert [r["v"] for r in got.collect()] == ["a"]


def test_no_whole_row_is_shuffled_where_few_keys_repeat(spark, crawls, monkeypatch):
    for frame in (crawls, crawls.withColumn(dedup.ROW_HASH, dedup.row_hash(crawls))):
        plan = keep_latest(frame.filter("k < 62"), ["k", "s"], "t", "path")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        sellers = spark.createDataFrame([("a",)], "s string").withColumnRenamed("s", "seller_id")
        offers = crawls.select(F.col("k").alias("product_id"), F.col("s").alias("seller_id"), F.col("t").alias(silver.CRAWL_TIME), "v")
        seen = []
        monkeypatch.setattr(silver, "clean_products", lambda offers, rule: seen.append(offers) or offers)
        got = silver.silver_products(offers, sellers)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert seen and "SortMergeJoin" not in plan and "v#" in plan
    finally:
        spark.conf.set(conf, before)


def test_a_published_run_looks_nothing_up(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger.csv")
    listing = spark.createDataFrame([(1, 2, 3, 4, "a"), (1, 5, 3, 4, "b")], "pid bigint, spid bigint, seller_id bigint, category_id bigint, slug string")
    assert frontier.run_frontier(spark, listing, path, run="d").n_rows == 1
    stored = rows(frontier.open_or_init(spark, path, LEDGER))
    monkeypatch.setattr(frontier, "new_candidates", lambda *_: pytest.fail("looked up"))
    assert frontier.run_frontier(spark, listing, path, run="d").n_rows == 0
    assert rows(frontier.open_or_init(spark, path, LEDGER)) == stored == [(1, 2, 3, 4, "a")]


def test_packed_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "PACKED_DOCUMENTS", 40)
    n = writers.write_json(spark.range(100).coalesce(1).select("id", F.lit(None).cast("string").alias("none")), str(tmp_path / "d"), packed=True)
    files = sorted(Path(tmp_path / "d").glob("part-*.gz"))
    lines = [json.loads(line) for f in files for line in gzip.open(f, "rt")]
    assert n == 100 and len(files) == 3 and sorted(d["id"] for d in lines) == list(range(100)) and all("none" in d for d in lines)


def test_numbers_with_a_point_are_not_cast_to_integers(spark):
    texts = ["5.", " 5.0 ", "5", "-7.9", "1e3", "1.0E7", "abc", None, "", " 12 ", "9007199254740993", "9007199254740993.0", "9" * 20, "NaN", ".5", "+3", "3\t"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r[0] for r in df.select(whole_number(F.col("t"))).collect()]
    assert got == [5, 5, 5, -7, 1000, 10**7, None, None, None, 12, 2**53 + 1, 2**53, None, None, 0, 3, 3]
    plan = df.select(whole_number(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" in plan or "contains" in plan.lower()
    numbers = spark.createDataFrame([(7.9, 2**53 + 1, True)], "d double, n bigint, b boolean")
    assert tuple(numbers.select(*[whole_number(F.col(c)) for c in numbers.columns]).first()) == (7, 2**53 + 1, 1)


def test_wide_rows_run_in_methods_of_a_size_that_is_compiled(spark, tmp_path, monkeypatch):
    name = "spark.sql.codegen.hugeMethodLimit"
    before, seen, lake = spark.conf.get(name), [], Lake(str(tmp_path))
    writers.write_json(spark.sql("SELECT named_struct('seller', named_struct('id', 1)) AS data"), f"{lake.bronze}/sellers", packed=True)
    build = silver.silver_sellers
    monkeypatch.setattr(silver, "silver_sellers", lambda flat: seen.append(spark.conf.get(name)) or build(flat))
    assert silver.run_sellers(spark, lake, layout="lines").n_rows == 1
    assert seen == ["8000"] and spark.conf.get(name) == before
