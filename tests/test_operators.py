"""Operators: exact rows, properties, and the plans that large inputs rely on."""

import pytest
from pyspark.sql import functions as F

from lakemart.operators import (
    all_true,
    check_declared_keys,
    flatten_listing,
    foreign_key_violations,
    has_id,
    keep_known,
    keep_new,
    keep_one,
    primary_key_violations,
    select_existing,
    union_all,
)
from lakemart.plans import frontier


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def offers(spark):
    data = [(i % 7 if i % 3 else 1, i % 2, None if i % 5 == 0 else i, f"t{i % 4}") for i in range(200)]
    return spark.createDataFrame(data, "p int, s int, n int, t string")


def test_keep_one_does_not_depend_on_partitioning(offers):
    once = rows(keep_one(offers, ["p", "s"]))
    assert len(once) == len({r[:2] for r in once})
    for n in (1, 3, 16):
        assert rows(keep_one(offers.repartition(n), ["p", "s"])) == once
    assert rows(keep_one(keep_one(offers, ["p", "s"]), ["p", "s"])) == once


def test_keep_one_order(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 3, "c"), (2, None, "d")], "k int, n int, t string")
    assert rows(keep_one(df, ["k"])) == [(1, 3, "c"), (2, None, "d")]
    assert rows(keep_one(df, ["k"], [F.col("n").desc_nulls_last()])) == [(1, 5, "b"), (2, None, "d")]
    assert rows(keep_one(df.select("k"), ["k"])) == [(1,), (2,)]


def test_keep_one_with_map_column(spark):
    df = spark.createDataFrame([(1, {"a": 2}), (1, {"a": 1})], "k int, m map<string, int>")
    assert rows(keep_one(df, ["k"])) == [(1, {"a": 1})]


def test_keep_one_limits_before_the_shuffle(offers):
    plan = keep_one(offers, ["p", "s"])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_semi_and_anti_split_the_input(spark, offers):
    known = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (None, 0)], "p int, s int")
    for unique in (True, False):
        kept = keep_known(offers, known, ["p", "s"], unique)
        fresh = keep_new(offers, known, ["p", "s"], unique)
        assert rows(kept.unionByName(fresh)) == rows(offers)
        assert {r[:2] for r in rows(kept)} == {(1, 0), (2, 1)}


def test_heavy_key_is_split(spark):
    """A key with a third of the rows: adaptive execution reads its partition in several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        heavy = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        left = spark.range(0, 120_000, 1, 8).select(heavy.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("t"))
        right = left.filter(F.col("id") % 2 == 0).select("k")
        once = spark.range(0, 120_000, 1, 8).filter("(id % 2 = 0 AND id % 3 <> 0) OR id = 7").withColumnRenamed("id", "k")
        parents = ((True, once), (False, right), (False, right.distinct()), (False, keep_one(left.filter("id % 2 = 0").select("k", "id"), ["k"])))
        for unique, parent in parents:
            kept = keep_known(left, parent, ["k"], parent_unique=unique)
            assert kept.agg(F.count("*")).first()[0] == 40_001 + 40_000
            kept.collect()
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in plan
            assert "skewed" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_filters_reach_the_scan(spark, tmp_path, offers):
    offers.write.parquet(str(tmp_path / "offers"))
    df = spark.read.parquet(str(tmp_path / "offers"))
    plan = df.filter(has_id("p")).select("p")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(p), Not(EqualTo(p,0))" in plan
    assert "ReadSchema: struct<p:int>" in plan


def test_all_true(spark):
    df = spark.createDataFrame([(1, True, True), (2, True, None), (3, False, True)], "i int, a boolean, b boolean")
    assert rows(df.filter(all_true("a", F.col("b"))).select("i")) == [(1,)]


def test_project_and_union(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert select_existing(a, ["b", "zz", "a"]).columns == ["b", "a"]
    assert rows(union_all([a, b])) == [(1, "x", None), (None, "y", 2.0)]


def test_key_checks(spark):
    child = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 3), (3, 9), (3, 9)], "a int, b int")
    assert rows(primary_key_violations(child, ["a", "b"])) == [
        (1, 1, 2, "duplicate"),
        (2, None, 1, "null"),
        (3, 9, 2, "duplicate"),
        (None, 3, 1, "null"),
    ]
    parent = spark.createDataFrame([(1,), (3,)], "k int")
    assert rows(foreign_key_violations(child, ["b"], parent, ["k"])) == [(9, 2)]


def test_declared_keys(spark):
    tables = {
        "sellers": spark.createDataFrame([(1,), (1,)], "seller_id bigint"),
        "products": spark.createDataFrame([(5, 1), (6, 2)], "product_id bigint, seller_id bigint"),
    }
    assert rows(check_declared_keys(tables)) == [
        ("products", "foreign", "seller_id", "sellers", 1, 1),
        ("products", "primary", "product_id", None, 0, 0),
        ("sellers", "primary", "seller_id", None, 1, 2),
    ]


def test_frontier(spark):
    page = spark.createDataFrame(
        [([(1, 10, 5), (1, 11, 5), None, (2, 20, 5)],), ([],), (None,)],
        "data array<struct<id: bigint, seller_product_id: bigint, seller_id: bigint>>",
    )
    listing = flatten_listing(page, F.lit(7).cast("bigint"), F.lit("sach"))
    assert rows(listing) == [(1, 10, 5, 7, "sach"), (1, 11, 5, 7, "sach"), (2, 20, 5, 7, "sach")]
    ledger = spark.createDataFrame([(2, 20, 5, 7, "sach")], "pid bigint, spid bigint, seller_id bigint, category_id bigint, slug string")
    fresh = frontier.new_candidates(listing, ledger)
    assert rows(fresh) == [(1, 10, 5, 7, "sach")]
    fetched = frontier.fully_fetched(fresh.withColumn("ok", F.lit(True)), "ok", F.col("spid") < 11)
    assert rows(frontier.extended_ledger(ledger, fetched)) == [(1, 10, 5, 7, "sach"), (2, 20, 5, 7, "sach")]
    assert rows(frontier.fully_fetched(fresh, F.col("spid") > 11)) == []


def test_folder_counts(spark):
    paths = ["a/1/x.json", "a/1/y.json", "a/2/x.json", "b/1/x.json", "b//x.json", "c/only.json", "top.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert rows(frontier.folder_counts(df, F.col("p"))) == [("a", 2), ("b", 1), (None, 3)]
