"""Newest rows, runs that are published once, files listed by tasks, and the document layout."""

import json
import os
import shutil
import threading
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakemart import fixed, schemas
from lakemart.operators.dedup import keep_latest, row_hash
from lakemart.operators.keys import keep_known, key_filter, may_be_known, merged_filter
from lakemart.plans import bronze, frontier, silver
from lakemart.sources import DATASETS, Lake, appends, files, readers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCHEMA = "k int, s string, at timestamp, path string, v string, l array<string>"


@pytest.fixture(scope="module")
def crawls(spark):
    data = [
        (1, "a", 10, "p", "old", []),
        (1, "a", 30, "p", "new", ["x"]),
        (1, "a", None, "p", "no time", None),
        (1, "b", 5, "q", "second path", []),
        (1, "b", 5, "p", "first path", []),
        (None, "a", 1, "p", "null key", []),
        (None, "a", 2, "p", "null key, newer", []),
        (2, None, None, None, "alone", []),
        *[(3, "a", 7, "p", "again", ["y"])] * 40,
        (3, "a", 6, "p", "older", []),
    ]
    frame = spark.createDataFrame([(k, s, at, p, v, tags) for k, s, at, p, v, tags in data], "k int, s string, t long, path string, v string, l array<string>")
    return frame.select("k", "s", F.timestamp_seconds("t").alias("at"), "path", "v", "l")


def test_newest_crawl_survives(crawls):
    want = ["again", "alone", "first path", "new", "null key, newer"]
    for n in (1, 3, 7):
        got = keep_latest(crawls.repartition(n), ["k", "s"], "at", "path")
        assert got.columns == crawls.columns and sorted(r["v"] for r in got.collect()) == want


def test_without_times_the_choice_does_not_depend_on_partitioning(crawls):
    once = rows(keep_latest(crawls, ["k"]))
    assert len(once) == 4 and all(rows(keep_latest(crawls.repartition(n), ["k"])) == once for n in (2, 5))
    assert keep_latest(crawls.filter("false"), ["k"], "at").count() == 0


def test_narrow_rows_may_be_left_out_before_and_after_the_choice(spark, crawls):
    known = spark.createDataFrame([("b",)], "s string")
    before = keep_latest(crawls, ["k"], "at", "path", needed=["s"], before=lambda r: keep_known(r, known, ["s"]))
    after = keep_latest(crawls, ["k", "s"], "at", "path", after=lambda r: keep_known(r, known, ["s"]))
    assert [r["v"] for r in before.collect()] == [r["v"] for r in after.collect()] == ["first path"]


def test_only_narrow_rows_are_sorted(spark, tmp_path):
    """The choice reads keys, time, path and hash of a stored table; what sorts is never the whole row."""
    wide = spark.range(100).select((F.col("id") % 7).alias("k"), F.timestamp_seconds("id").alias("at"), F.lit("p").alias("path"), *[F.col("id").alias(f"c{i}") for i in range(30)])
    wide.withColumn("_row_hash", row_hash(wide)).write.parquet(str(tmp_path / "wide"))
    seen = []

    def watched(chosen):
        seen.append(chosen._jdf.queryExecution().executedPlan().toString())
        return chosen

    got = keep_latest(spark.read.parquet(str(tmp_path / "wide")), ["k"], "at", "path", after=watched)
    assert got.columns == wide.columns and got.count() == 7 and {r["c5"] for r in got.collect()} == set(range(93, 100))
    assert "c5" not in seen[0] and "WindowGroupLimit" in seen[0] and "Sort [k#" in seen[0]
    final = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in final and not any("c5" in line for line in final.splitlines() if "Sort [" in line)


def test_a_run_is_published_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert appends.create_once(spark.range(2), path) and not appends.create_once(spark.range(9), path)
    assert appends.append_run(spark.range(5), path, "a") == 5
    assert appends.append_run(spark.range(7), path, "a") == 0
    half = f"{path}/_staging/b-broken"
    spark.range(1000).write.parquet(half)
    os.remove(next(os.path.join(half, f) for f in os.listdir(half) if f == "_SUCCESS"))
    assert readers.read_runs(spark, path).count() == 7
    assert appends.append_run(spark.range(3), path, "b") == 3
    assert readers.read_runs(spark, path).count() == 10 and readers.read_runs(spark, path).columns == ["id"]
    assert sorted(appends.run_folders(spark, path)) == ["a", "b", "initial"]
    with pytest.raises(ValueError, match="run is named"):
        appends.append_run(spark.range(1), path, "a/b")


def test_two_runs_of_one_name_at_once(spark, tmp_path):
    path, added = str(tmp_path / "t"), []
    appends.create_once(spark.range(0), path)
    threads = [threading.Thread(target=lambda: added.append(appends.append_run(spark.range(50), path, "same"))) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(added) == [0, 0, 0, 50] and readers.read_runs(spark, path).count() == 50


def test_key_filter_holds_every_key(spark):
    keys = spark.range(5000).select(F.col("id").alias("a"), (F.col("id") % 9).cast("string").alias("b"))
    words = merged_filter(key_filter(keys.filter("a < 3000"), ["a", "b"]).unionAll(key_filter(keys.filter("a >= 3000"), ["a", "b"])))
    others = spark.range(5000, 25000).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    assert may_be_known(keys, ["a", "b"], words, "m").filter("NOT m").isEmpty()
    assert may_be_known(others, ["a", "b"], words, "m").filter("m").count() < 20
    nulls = spark.createDataFrame([(None, None)], "a long, b string")
    assert may_be_known(nulls, ["a", "b"], key_filter(nulls, ["a", "b"]), "m").first()["m"]


def test_ledger_without_run_folders_still_works(spark, tmp_path):
    path = str(tmp_path / "ledger.csv")
    (tmp_path / "ledger.csv").write_text("pid,spid,seller_id,category_id,slug\n1,2,3,4,s\n")
    assert frontier.ledger_filter(spark, path) is None
    listing = spark.createDataFrame([(1, 9, 3, 4, "s"), (2, 9, 3, 4, "s")], schemas.LEDGER)
    assert rows(frontier.new_candidates(listing, readers.read_csv(spark, path, schemas.LEDGER)).select("pid")) == [(2,)]


def test_runs_without_a_filter_get_one(spark, tmp_path):
    path = str(tmp_path / "ledger")
    first = spark.createDataFrame([(1, 1, 1, 1, "s")], schemas.LEDGER)
    readers.open_or_init(spark, path, schemas.LEDGER, first)
    second = spark.createDataFrame([(1, 5, 1, 1, "s"), (2, 5, 1, 1, "s")], schemas.LEDGER)
    assert frontier.run_frontier(spark, second, path, run="d").n_rows == 1
    assert rows(readers.open_or_init(spark, path, schemas.LEDGER).select("pid", "spid")) == [(1, 1), (2, 5)]


ODD = ["a b/ü/product_1.json", "100%/x+y/product_2.json", "a b/product 3.json", "seller_1.json", "c/reviews_1_2_3.json", "c/notes.txt", "c/product_4.json.bak"]


def test_files_of_odd_names(spark, tmp_path):
    root = str(tmp_path / "tree")
    frame = spark.createDataFrame([(p, f"text of {p}\n") for p in ODD], "path string, text string")
    assert files.write_files(frame, root) == len(ODD) == files.write_files(frame, f"file:{root}")
    (tmp_path / "tree" / "c" / "_hidden.json").write_text("x")
    listed = files.list_tree(spark, root)
    assert sorted(r["path"] for r in listed.collect()) == sorted(f"{root}/{p}" for p in ODD)
    assert {r["path"][len(root) + 1 :]: r["text"] for r in files.read_files(listed).collect()} == {p: f"text of {p}\n" for p in ODD}
    named = listed.select(bronze.dataset_of(F.substring_index("path", "/", -1)).alias("d")).collect()
    assert Counter(r["d"] for r in named) == {"products": 3, "sellers": 1, "reviews": 1, None: 2}
    assert files.list_tree(spark, str(tmp_path / "none")).count() == 0


def test_paths_of_other_stores():
    for path, prefix, inner in (("file:/a/b", "file:", "/a/b"), ("file:///a b/c", "file://", "/a b/c"), ("/a", "", "/a")):
        assert files._open(path)[1:] == (inner, prefix)


def test_a_changed_document_is_compacted_and_wins(spark, tmp_path):
    lake = Lake(str(tmp_path))
    folder = tmp_path / "bronze" / "market" / "x"
    folder.mkdir(parents=True)

    def write(name, seller, number=1, **top):
        (folder / name).write_text(json.dumps({**top, "data": {"seller": {"id": number, "name": seller}}}, indent=2))

    write("seller_1.json", "first")
    write("seller_2.json", "told to be old", 2, crawled_at=1_000)
    write("seller_3.json", "told to be new", 2, crawled_at=2_000)
    (folder / "seller_bad.json").write_text('{"data": ')
    (folder / "seller_empty.json").write_text("")
    report = silver.run_sellers(spark, lake)
    assert (report.n_rows, report.n_rejects) == (2, 2)
    time.sleep(0.01)
    write("seller_1.json", "second")
    assert silver.run_sellers(spark, lake).n_rows == 2
    got = spark.read.parquet(lake.path("silver", "sellers")).select("seller_id", "seller_name")
    assert rows(got) == [(1, "second"), (2, "told to be new")]
    refused = spark.read.parquet(lake.path("rejects", "sellers")).collect()
    assert {r["source_path"].rsplit("/", 1)[1]: r["raw"] for r in refused} == {"seller_bad.json": '{"data": ', "seller_empty.json": ""}
    assert bronze.manifest(spark, lake).count() == 6
    assert bronze.compact(spark, lake, "sellers") == 0 == bronze.compact(spark, lake, "products")


@pytest.mark.parametrize("with_rejects", [True, False])
@pytest.mark.parametrize("parents", ["empty", "unmatched"])
def test_silver_under_parents_without_a_match(spark, tmp_path, parents, with_rejects):
    lake = Lake(str(tmp_path))
    (tmp_path / "bronze" / "market" / "products").mkdir(parents=True)
    (tmp_path / "bronze" / "market" / "reviews").mkdir(parents=True)
    bad = "{\n" if with_rejects else ""
    (tmp_path / "bronze" / "market" / "products" / "a.json").write_text('{"id": 1, "current_seller": {"id": 2}}\n' + bad)
    (tmp_path / "bronze" / "market" / "reviews" / "a.json").write_text('{"data": [{"id": 1, "product_id": 1, "seller": {"id": 2}}]}\n' + bad)
    keys = spark.createDataFrame([] if parents == "empty" else [(9, 9)], "product_id long, seller_id long")
    keys.write.parquet(str(tmp_path / "parent"))
    for report in (silver.run_products(spark, lake, "lines", str(tmp_path / "parent")), silver.run_reviews(spark, lake, "lines", str(tmp_path / "parent"))):
        assert (report.status, report.n_rows, report.n_rejects) == (fixed.SUCCESS, 0, int(with_rejects))
        assert not with_rejects or spark.read.parquet(lake.path("rejects", report.table)).count() == 1


def test_rejects_are_stored_by_the_pass_that_parses(spark, tmp_path, monkeypatch):
    """The documents are gone before rejects are written; each reject is one row, and a blank document no reject."""
    bronze_folder = tmp_path / "bronze" / "market"
    bad = ["no document", '{"data": [{"id": 8}, {"id": 9}]', '{"id": 8, "brand": {']
    good = {
        "sellers": ['{"data": {"seller": {"id": 1}}}', '{"data": {"seller": {}}}', "{}", '{"data": 5}'],
        "products": ['{"id": 1, "current_seller": {"id": 1}, "brand": []}', "{}"],
        "reviews": ['{"data": [{"id": 1, "product_id": 1, "seller": {"id": 1}}, {"id": 2}, null]}', '{"data": []}', "{}"],
    }
    for name, documents in good.items():
        (bronze_folder / name).mkdir(parents=True)
        (bronze_folder / name / "a.json").write_text("\n".join(documents + bad) + "\n")
    spark.createDataFrame([(1, 1)], "product_id long, seller_id long").write.parquet(str(tmp_path / "parent"))
    publish = silver.publish
    monkeypatch.setattr(silver, "publish", lambda name, *rest: (shutil.rmtree(bronze_folder / name), publish(name, *rest))[1])
    lake, parent = Lake(str(tmp_path)), str(tmp_path / "parent")
    reports = [silver.run_sellers(spark, lake, "lines"), silver.run_products(spark, lake, "lines", parent), silver.run_reviews(spark, lake, "lines", parent)]
    for report in reports:
        assert (report.status, report.n_rows, report.n_rejects) == (fixed.SUCCESS, 1, 3)
        refused = spark.read.parquet(lake.path("rejects", report.table))
        assert refused.columns == ["source_path", "raw"] and sorted(r["raw"] for r in refused.collect()) == sorted(bad)
        assert readers.REFUSED not in spark.read.parquet(report.path).columns


@pytest.mark.parametrize("name", sorted(DATASETS))
def test_a_blank_document_flattens_to_one_row(spark, name):
    source = DATASETS[name]
    document = spark.range(1).select(F.from_json(F.lit(source.blank), source.schema).alias("d")).select("d.*")
    (row,) = source.flatten(document).collect()
    assert row.asDict()[f"{name[:-1]}_id"] is None
