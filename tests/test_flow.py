"""A small bronze tree, one document per file, through silver, gold and the warehouse."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakemart import fixed
from lakemart.operators import check_declared_keys, foreign_key_violations
from lakemart.plans import gold, silver, warehouse
from lakemart.plans.report import report_frame
from lakemart.schemas import GOLD
from lakemart.sources import Lake, list_tables


def product(number, seller, **fields):
    return {"id": number, "sku": f"SKU{number}", "name": f"P{number}", "current_seller": {"id": seller, "name": "S"}, **fields}


PRODUCTS = [
    product(
        1,
        10,
        short_url="/p1",
        images=[{"base_url": "u1"}, {"base_url": "u2"}],
        list_price=200,
        price=150.0,
        discount_rate=25,
        all_time_quantity_sold=7,
        rating_average=4.5,
        review_count=2,
        specifications=[{"attributes": [{"name": "Màu", "value": "đỏ"}, {"name": "Size"}]}, {"name": "empty"}],
        breadcrumbs=[{"category_id": 8322, "name": "Sách"}, {"category_id": 1, "name": "Văn học"}, {"category_id": 0, "name": "P1"}],
        tracking_info={"amplitude": {"is_authentic": 1, "is_freeship_xtra": False, "is_hero": True, "is_top_brand": True, "return_reason": "any_reason"}},
        brand={"id": 5, "name": "Bee"},
        authors=[{"id": 100, "name": "An"}, {"id": 101, "name": "Bình"}],
        warranty_info=[{"name": "Thời gian bảo hành", "value": "12 tháng"}, None, {"name": "Nơi bảo hành", "value": "HN"}],
    ),
    product(1, 11, brand={"id": 5, "name": "Bee"}, tracking_info={"amplitude": {"is_top_brand": False}}, authors=[{"id": 100, "name": "An"}]),
    product(2, 10, brand={"id": 0, "name": ""}, images=[], breadcrumbs=[{"category_id": 9, "name": "x"}], tracking_info={"amplitude": {"return_reason": "swap"}}),
    product(3, 99),
    product(4, 0),
]


def seller(number, **fields):
    return {"data": {"seller": {"id": number, "name": f"Shop {number}", **fields}}}


SELLERS = {
    10: seller(10, avg_rating_point=4.7, review_count=9, total_follower=None, is_official=True, store_level="OFFICIAL"),
    11: seller(11),
    0: seller(0),
    99: {"data": {"seller": {}}},
}


def author(name, **fields):
    summary = {"joined_time": "Đã tham gia 5 tháng", "total_review": 3, "total_thank": 1}
    return {"full_name": name, "purchased_at": 1700000000, "avatar_url": "a", "contribute_info": {"summary": summary}, **fields}


def review(number, product_id, seller_id, customer, **fields):
    base = {"id": number, "product_id": product_id, "title": "t", "content": "c", "status": "approved", "rating": 5}
    return {**base, "seller": {"id": seller_id}, "customer_id": customer, "created_at": 1700000100, **fields}


PAGES = {
    (1, 10, 1): [
        review(1000, 1, 10, 7, created_by=author("Lan")),
        review(1001, 1, 10, 7, created_by=None, created_at=1700000200),
        review(1002, 1, 10, None),
    ],
    (1, 10, 2): [review(1000, 1, 10, 7, created_by=author("Lan"))],
    (2, 10, 1): [review(1003, 2, 10, 8, created_by={"full_name": "Minh", "purchased_at": None})],
    (3, 99, 1): [review(1004, 3, 99, 9), {"id": 1005, "product_id": 1, "customer_id": 9}],
    (1, 11, 1): [],
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    root = base / "bronze" / "market"
    for document in PRODUCTS:
        pair = f"{document['id']}_{document['current_seller']['id']}"
        folder = root / "sach" / pair
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"product_{pair}.json").write_text(json.dumps(document, indent=4, ensure_ascii=False), encoding="utf-8")
        (folder / f"seller_{pair}.json").write_text(json.dumps(SELLERS[document["current_seller"]["id"]], indent=4))
    for (number, seller_id, page), reviews in PAGES.items():
        folder = root / "sach" / f"{number}_{seller_id}" / "reviews"
        folder.mkdir(parents=True, exist_ok=True)
        name = f"reviews_{number}_{seller_id}_{page}.json"
        (folder / name).write_text(json.dumps({"data": reviews}, indent=4, ensure_ascii=False), encoding="utf-8")
    (root / "sach" / "1_10" / "product_broken.json").write_text('{"id": 1,')
    (root / "sach" / "1_10" / "notes.json").write_text("{}")
    (root / "categories.csv").write_text("title,slug,category_id\nSách,sach,8322\nĐồ chơi,do-choi,2549\n", encoding="utf-8")
    lake = Lake(str(base))
    reports = [
        silver.run_sellers(spark, lake),
        silver.run_categories(spark, lake),
        silver.run_products(spark, lake),
        silver.run_reviews(spark, lake),
    ]
    assert [(r.table, r.status, r.n_rows) for r in reports] == [
        ("sellers", fixed.SUCCESS, 2),
        ("categories", fixed.SUCCESS, 2),
        ("products", fixed.SUCCESS, 3),
        ("reviews", fixed.SUCCESS, 4),
    ]
    for source in ("sellers", "categories", "products", "reviews"):
        assert {r.status for r in gold.run_gold(spark, lake, source)} == {fixed.SUCCESS}
    return lake


def table(spark, lake, name, layer="gold"):
    df = spark.read.parquet(lake.path(layer, name))
    if name in GOLD and layer == "gold":
        assert df.dtypes == [(c, t.replace(": ", ":").replace(", ", ",")) for c, t in GOLD[name].columns.items()] or name == "categories"
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_sellers(spark, lake):
    assert table(spark, lake, "sellers") == [
        (10, "Shop 10", None, 4.7, 9, 0, 0, True, "OFFICIAL"),
        (11, "Shop 11", None, 0.0, 0, 0, 0, None, None),
    ]


def test_categories(spark, lake):
    assert table(spark, lake, "categories") == [("Sách", "sach", 8322), ("Đồ chơi", "do-choi", 2549)]


def test_products(spark, lake):
    none = "Không bảo hành"
    first, second, third = table(spark, lake, "products")
    assert first == (
        1, 10, "SKU1", "P1", "/p1", ["u1", "u2"], None, 150, 25, None, None, 7, 4.5, 2, "Màu: đỏ\nSize: ", "Sách / Văn học",
        8322, True, False, True, "any_reason", 5, [(100, "An"), (101, "Bình")], none, "HN", 360, "Bất cứ lý do gì",
    )
    assert second[:2] == (1, 11)
    assert second[11:17] == (0, None, None, "", None, None)
    assert second[21:] == (5, [(100, "An")], none, none, 0, "Không đổi trả")
    assert third[:2] == (2, 10) and third[5] == [] and third[15:17] == ("", 9)
    assert third[20:23] == ("swap", 0, []) and third[26] == "swap"


def test_brands_and_authors(spark, lake):
    assert table(spark, lake, "brands") == [(5, "Bee", True)]
    assert table(spark, lake, "authors") == [(100, "An"), (101, "Bình")]
    assert table(spark, lake, "products_authors") == [(1, 100), (1, 101)]
    assert table(spark, lake, "images_url") == [(1, 10, "u1"), (1, 10, "u2")]


def test_reviews(spark, lake):
    assert [r[0] for r in table(spark, lake, "reviews")] == [1000, 1001, 1002, 1003]
    assert table(spark, lake, "reviews")[0] == (1000, "t", "c", "approved", 5, 1, 10)
    bought, written = dt.datetime(2023, 11, 14, 22, 13, 20), dt.datetime(2023, 11, 14, 22, 15)
    silver_rows = spark.read.parquet(lake.path("silver", "reviews")).select(
        "review_id", F.date_format("created_ts", "HH:mm:ss"), F.date_format("purchased_ts", "HH:mm:ss"),
        "joined_days", "total_review", "total_thank",
    )
    assert sorted(tuple(r) for r in silver_rows.collect()) == [
        (1000, written.strftime("%H:%M:%S"), bought.strftime("%H:%M:%S"), 150, 3, 1),
        (1001, "22:16:40", None, 0, 0, 0),
        (1002, "22:15:00", None, 0, 0, 0),
        (1003, "22:15:00", None, 0, 0, 0),
    ]


def test_customers(spark, lake):
    # Customer 7 wrote an anonymous review last; the one that names them stands for them.
    assert table(spark, lake, "customers") == [(7, "Lan", "a", 3, 1, 150), (8, "Minh", None, 0, 0, 0)]
    links = spark.read.parquet(lake.path("gold", "customer_review")).select("customer_id", "review_id", F.unix_seconds("created_ts"))
    assert sorted(tuple(r) for r in links.collect()) == [(7, 1000, 1700000100), (7, 1001, 1700000200), (8, 1003, 1700000100)]
    bought = spark.read.parquet(lake.path("gold", "customer_purchase")).select(
        "customer_id", "product_id", "seller_id", F.unix_seconds("purchased_ts")
    )
    assert sorted((tuple(r) for r in bought.collect()), key=repr) == [(7, 1, 10, 1700000000), (7, 1, 10, None), (8, 2, 10, None)]


def test_keys(spark, lake):
    tables = {name: spark.read.parquet(lake.path("gold", name)) for name in GOLD}
    broken = {
        (r["table"], r.kind, r["key"]): (r.n_keys, r.n_rows) for r in check_declared_keys(tables).collect() if r.n_keys
    }
    assert broken == {
        ("products", "primary", "product_id"): (1, 2),
        ("products", "foreign", "brand_id"): (1, 1),
        ("products", "foreign", "category_id"): (1, 1),
        ("customer_purchase", "primary", "customer_id, product_id, seller_id"): (1, 2),
    }
    offers = spark.read.parquet(lake.path("silver", "products"))
    assert foreign_key_violations(tables["reviews"], ["product_id", "seller_id"], offers).isEmpty()


def test_warehouse(spark, lake, tmp_path):
    root = lake.layer("gold")
    assert set(list_tables(spark, root)) == set(gold.OUTPUTS)
    reports = warehouse.load_layer(spark, root, warehouse.parquet_sink(str(tmp_path)))
    frame = report_frame(spark, reports)
    assert {r["table"]: r.n_rows for r in frame.collect()} == {
        name: spark.read.parquet(lake.path("gold", name)).count() for name in gold.OUTPUTS
    }
    assert {r.status for r in frame.collect()} == {fixed.SUCCESS}


def test_empty_lake(spark, tmp_path):
    empty = Lake(str(tmp_path))
    assert silver.run_sellers(spark, empty).path is None
    assert silver.run_categories(spark, empty).status == fixed.SKIPPED_EMPTY
    with pytest.raises(ValueError, match="unknown silver table"):
        gold.run_gold(spark, empty, "orders")
    with pytest.raises(ValueError, match="cannot read required input"):
        gold.run_gold(spark, empty, "products")


def test_one_failing_output_leaves_the_others(spark, lake, tmp_path):
    offers = spark.read.parquet(lake.path("silver", "products")).withColumn("authors", F.lit(1))
    reports = {r.table: r.status for r in gold.build_outputs(offers, "products", Lake(str(tmp_path)))}
    assert reports["authors"].startswith(fixed.FAILED) and reports["products_authors"].startswith(fixed.FAILED)
    assert reports["products"] == reports["brands"] == reports["images_url"] == fixed.SUCCESS
    without = gold.build_outputs(offers.drop("authors", "brand_id"), "products", Lake(str(tmp_path / "b")))
    assert {r.table for r in without if r.status == fixed.SKIPPED_COLUMNS} == {"authors", "products_authors", "brands"}
