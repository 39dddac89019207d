"""Choices by the place of a row in a stored table: the same rows as by comparing whole rows, in parts, with no whole row shuffled."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakemart.operators import dedup, keys, places
from lakemart.operators.dedup import keep_latest
from lakemart.operators.keys import keep_known, keep_known_in_parts
from lakemart.plans import silver
from lakemart.queries import QUERIES, documents, jobs
from lakemart.queries.registry import Tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def crawls(spark):
    """Keys alone, repeated, null, equal in time, in time and path, and in every column; offers known, unknown and null."""
    data = [(i % 40, i % 3, i % 5 or None, i * 7 % 4, f"p{i % 2}", f"text {i % 90}") for i in range(400)]
    data += [(None, 1, 1, t, "p", f"null {t}") for t in (1, 2, None)] + [(None, 2, 1, 2, None, "null, no path")]
    data += [(60, 1, 1, 5, "p", "equal")] * 5 + [(61, 1, 2, None, "p", "no time"), (61, 2, 2, 0, "q", "time"), (62, 0, None, 9, "q", "unknown")]
    return spark.createDataFrame(data, "k int, a int, b int, t long, path string, v string").repartition(6)


def test_places_choose_what_the_whole_row_chooses(spark, crawls, monkeypatch):
    known = spark.createDataFrame([(a, b) for a in (1, 2, 1) for b in (1, 2, 3, None)], "a int, b int").repartition(3)
    some = keep_known(crawls, known, ["a", "b"])
    for newest, path, part_rows in (("t", "path", 250), (None, "path", 1 << 25)):
        want = rows(keep_latest(some, ["k"], newest, path))
        every = rows(keep_latest(crawls, ["k"], newest, path))
        with monkeypatch.context() as m:
            m.setattr(places, "PART_ROWS", part_rows)
            m.setattr(dedup, "REPEATED_KEYS", -1)
            m.setattr(dedup, "_by_times", lambda *_: pytest.fail("whole rows meet by a shuffle"))
            before = lambda r: keep_known_in_parts(r, known, ["a", "b"])
            got = keep_latest(crawls, ["k"], newest, path, needed=["a", "b"], before=before)
            assert got.columns == crawls.columns and rows(got) == want
            assert rows(keep_latest(crawls, ["k"], newest, path)) == every
    assert rows(keep_latest(crawls.filter("false"), ["k"], "t", needed=["a", "b"], before=lambda r: keep_known(r, known, ["a", "b"]))) == []


def test_reviews_of_many_offers_shuffle_no_whole_row(spark, crawls, monkeypatch):
    monkeypatch.setattr(keys, "FEW_ROWS", -1)
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        names = {"k": "review_id", "a": "product_id", "b": "seller_id", "v": "content"}
        reviews = crawls.select(*[F.col(c).alias(n) for c, n in names.items()], F.timestamp_seconds("t").alias(silver.CRAWL_TIME))
        others = ("created_at", "purchased_at", "joined_time", "total_review", "total_thank")
        reviews = reviews.withColumns({c: F.lit("1") for c in others})
        got = silver.silver_reviews(reviews, crawls.filter("a = 1").selectExpr("a AS product_id", "b AS seller_id"))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "content#" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
        assert {r["product_id"] for r in got.collect()} == {1}
    finally:
        spark.conf.set(conf, before)


def test_marks_name_rows_of_many_files(spark, monkeypatch):
    table = places.placed([spark.range(9000).repartition(2), spark.range(20000, 20100).coalesce(1)], "t")
    assert table.select(places.ROW_PLACE).distinct().count() == 9100
    named = F.col("id") % 64 == 63
    marks = places.marks([table.filter(named & (F.col("id") < 5000)), table.filter(named & (F.col("id") > 3000))])
    assert sorted(r[0] for r in places.marked(table, marks).select("id").collect()) == [i for i in (*range(9000), *range(20000, 20100)) if i % 64 == 63]
    assert places.marked(table, places.marks(table.filter("false"))).count() == 0


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_shuffle_files_go_with_the_write(spark):
    before = _shuffle_files(spark)
    table = places.stored(spark.range(1000).repartition(4), "t")
    assert _shuffle_files(spark) <= before and table.count() == 1000


@pytest.fixture
def folder(spark, tmp_path):
    """A few lines and orders; some lines come twice, some keys are null or unknown."""
    day = datetime(2020, 1, 1)
    lines = [
        (i % 23 + 1 if i % 19 else None, i % 5 + 1, i % 4 if i % 17 else None, i % 7 + 1, float(i % 50), 1000.0 + i, 0.0, 0.0, "ANR"[i % 3], "OF"[i % 2], day + timedelta(i))
        for i in range(160)
    ]
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double"
    line += ", l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    orders = [(i if i % 9 else None, i % 6, "OFP"[i % 3], 10.0 * i, day + timedelta(i), "1-URGENT") for i in range(1, 22)]
    order = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(lines + lines[:5], line).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(orders, order).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_pages_in_parts_are_all_pages(spark, folder, monkeypatch):
    t = Tables(spark, folder)
    want = rows(documents.review_pages(t))
    monkeypatch.setattr(places, "PART_ROWS", 60)
    parts = [rows(part) for part in documents.review_pages_in_parts(t)]
    assert len(parts) == 3 and sum(map(bool, parts)) > 1 and sorted((r for part in parts for r in part), key=repr) == want


@pytest.mark.parametrize("name", ["silver_reviews", "gold_customer_review", "gold_customer_purchase"])
def test_reviews_in_parts_give_the_same_rows(spark, folder, name, monkeypatch):
    want = rows(QUERIES[name](spark, folder))
    assert want
    jobs._written.clear()
    monkeypatch.setattr(keys, "FEW_ROWS", -1)
    monkeypatch.setattr(places, "PART_ROWS", 100)
    assert rows(QUERIES[name](spark, folder)) == want
