"""What adds up over runs and loads, tables loaded side by side, keys in the catalog, and markup by state."""

import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from lakemart import fixed
from lakemart.functions import links as L
from lakemart.operators import foreign_key_violations, primary_key_violations
from lakemart.plans import frontier, warehouse
from lakemart.plans.keys import KeyStore
from lakemart.schemas import GOLD
from lakemart.sources import write_parquet


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_sketches_add_up(spark, tmp_path):
    paths = spark.range(60_000).select(F.concat_ws("/", (F.col("id") % 3).cast("string"), (F.col("id") % 20_000).cast("string"), F.lit("f")).alias("p"))
    exact = {r["folder"]: r["n_subfolders"] for r in frontier.folder_counts(paths, F.col("p")).collect()}
    for run in ("a", "b", "b"):
        part = paths.filter(F.col("p") < "1") if run == "a" else paths.filter(F.col("p") >= "1")
        got = frontier.run_sketched_inventory(spark, part, F.col("p"), str(tmp_path / "s"), run)
    about = {r["folder"]: r["n_subfolders"] for r in got.collect()}
    assert about.keys() == exact.keys() and all(abs(about[f] - n) <= 0.03 * n for f, n in exact.items())
    assert frontier.sketched_counts(frontier.folder_sketches(paths.filter("false"), F.col("p"))).collect() == [(None, 0)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_incremental_checks_equal_full_ones(spark, tmp_path, seed):
    draw = random.Random(seed)
    loads = [[(draw.choice([None, *range(30)]), draw.choice(["x", "y", None])) for _ in range(draw.randrange(40))] for _ in range(4)]
    parents = [[draw.randrange(30) for _ in range(8)] for _ in range(4)]
    frame = [spark.createDataFrame(load, "k int, s string") for load in loads]
    above = [spark.createDataFrame([(p,) for p in set(ids)], "p int") for ids in parents]
    parent = KeyStore(spark, str(tmp_path / "p"), ["p"])
    primary = KeyStore(spark, str(tmp_path / "pk"), ["k", "s"])
    foreign = KeyStore(spark, str(tmp_path / "fk"), ["k"], parent)
    everything = frame[0].filter("false")
    known = above[0].filter("false")
    for i, (load, ids) in enumerate(zip(frame, above, strict=True)):
        parent.add(ids, f"r{i}")
        for store in (primary, foreign, primary):
            store.add(load, f"r{i}")
        everything, known = everything.unionAll(load), known.unionAll(ids)
        full = primary_key_violations(everything, ["k", "s"]).select("k", "s", "n_rows")
        assert rows(primary.violations().select("k", "s", "n_rows")) == rows(full)
        assert rows(foreign.violations().select("k", "n_rows")) == rows(foreign_key_violations(everything, ["k"], known, ["p"]))


def test_later_loads_read_no_earlier_rows(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "s"), ["id"])
    spark.range(100).write.parquet(str(tmp_path / "one"))
    assert store.add(spark.read.parquet(str(tmp_path / "one")), "one") == 0
    (tmp_path / "one").rename(tmp_path / "moved")
    assert store.add(spark.range(90, 120), "two") == 10
    assert rows(store.violations()) == [(i, 2) for i in range(90, 100)]


def test_a_slow_table_does_not_hold_up_the_rest(spark, tmp_path):
    for i, name in enumerate(("a_slow", "b", "c", "d_broken", "e")):
        write_parquet(spark.range(i + 1), str(tmp_path / "gold" / name))
    finished = []

    def sink(df, table):
        if table == "a_slow":
            time.sleep(4)
        if table == "d_broken":
            raise RuntimeError("no such place")
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == table
        return df.count()

    reports = warehouse.load_layer(spark, str(tmp_path / "gold"), sink, at_once=2, done=lambda r: finished.append(r.table))
    assert [(r.table, r.n_rows) for r in reports] == [("a_slow", 1), ("b", 2), ("c", 3), ("d_broken", 0), ("e", 5)]
    assert finished[-1] == "a_slow" and finished[:-1] == ["b", "c", "d_broken", "e"]
    assert [r.status for r in reports][3].startswith(fixed.FAILED)
    one_by_one = warehouse.load_layer(spark, str(tmp_path / "gold"), lambda df, table: df.count(), at_once=1)
    assert [r.n_rows for r in one_by_one] == [1, 2, 3, 4, 5]


def test_keys_come_back_from_the_catalog(spark, tmp_path):
    spark.sql("CREATE DATABASE keys_test")
    try:
        warehouse.create_tables(spark, "keys_test", str(tmp_path))
        for table in GOLD.values():
            primary, foreign = warehouse.declared_keys(spark, f"keys_test.{table.name}")
            assert primary == table.primary_key and foreign == {parent: columns for columns, parent in table.foreign_keys}
        spark.createDataFrame([(1, 1, None), (1, 1, None), (None, 2, None)], "customer_id long, review_id long, created_ts timestamp").write.insertInto("keys_test.customer_review")
        found = rows(warehouse.check_table(spark, "keys_test.customer_review"))
        assert sorted(((kind, parent, n) for kind, parent, _, n in found), key=repr) == [
            ("foreign", "customers", 2),
            ("foreign", "reviews", 1),
            ("foreign", "reviews", 2),
            ("primary", None, 1),
            ("primary", None, 2),
        ]
        spark.sql("CREATE TABLE keys_test.plain (a int) USING parquet")
        assert warehouse.check_table(spark, "keys_test.plain").count() == 0
    finally:
        spark.sql("DROP DATABASE keys_test CASCADE")


PIECES = [
    '<a href="/one">', "<a title='t' href='/two' >", "<a href=/three>", "<A HREF=\"/four\" title=x>", '<a data-x="1 > 0" href="/five">',
    '<!-- <a href="/c"> -->', "<script>var a = \"<a href='/s'>\" > 1;</script>", "<style>a > b {}</style>", "</a>", "text > more",
    '<img alt="<a href=\'/i\'>">', "<div class='x'>", "</div>", "< a href='/no'>", "<br/>", "<abbr href='/no'>", "<p\nclass = 'q'>",
]


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.found.append((dict(attrs).get("title"), dict(attrs).get("href")))


def test_anchors_match_a_parser(spark):
    draw = random.Random(4)
    pages = ["".join(draw.choices(PIECES, k=draw.randrange(1, 12))) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    got = {r["i"]: [tuple(x) for x in r["l"]] for r in frame.select("i", L.anchor_links(F.col("h")).alias("l")).collect()}
    for i, page in enumerate(pages):
        parser = Anchors()
        parser.feed(page)
        parser.close()
        assert got[i] == parser.found, page


def test_markup_by_state(spark):
    cases = {
        '<title><a href="/t"></title><textarea><a href="/u"></textarea><a href="/v">': ["/v"],
        '<script><a href="/never closed">': [],
        '<!-- never closed <a href="/x">': [],
        '<a href="/1"title="no space between">': ["/1"],
        "<a href=it's>": ["it's"],
        '<scripts><a href="/y"></scripts>': ["/y"],
        "<a href=''>": [""],
        '<!--><a href="/after"><!---><a href="/too">': ["/after", "/too"],
        "<a>": [None],
        "x" * 200_000 + '<a href="/far">' + "<" * 50_000: ["/far"],
    }
    frame = spark.createDataFrame([(p,) for p in cases], "h string")
    got = {r["h"]: [x["href"] for x in r["l"]] for r in frame.select("h", L.anchor_links(F.col("h")).alias("l")).collect()}
    assert got == cases
