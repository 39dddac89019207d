"""Expressions on hand-written edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart import functions as L


def values(spark, rows, schema, column):
    """``column`` over rows, in row order."""
    numbered = [(i, *(row if isinstance(row, tuple) else (row,))) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"row_no int, {schema}")
    return [r[0] for r in df.select(column.alias("v"), "row_no").orderBy("row_no").select("v").collect()]


@pytest.mark.parametrize(
    ("text", "days"),
    [
        (None, 0),
        ("", 0),
        (" \t\n ", 0),
        ("12 tháng", 360),
        ("\t12 tháng\n", 360),
        ("2 NĂM", 730),
        ("2năm", 730),
        ("1 năm 6 tháng", 365),
        ("6 tháng 1 năm", 365),
        ("7 ngày", 7),
        ("3 years", 1095),
        ("5 Months", 150),
        ("15 days", 15),
        ("10 tháng", 0),
        ("20 năm", 0),
        ("Không bảo hành", 0),
        ("No Warranty", 0),
        ("Trọn đời", 36500),
        ("trọn đời 0 đồng", 36500),
        ("12\u00a0tháng", 360),
        ("12\x1ftháng", 360),
        ("99999999999999999999 năm", 0),
        ("99999999999999999999 năm 2 năm", 0),
        ("999999999 năm", 0),
        ("2147483647 ngày", 2147483647),
        ("2147483648 ngày", 0),
        ("1234567891 days", 1234567891),
        ("00000000001234567891 days", 0),
        ("٣ năm", 1095),
        ("999999999 ngày", 999999999),
        ("theo hãng", 0),
        ("tháng 12", 0),
    ],
)
def test_warranty_days(spark, text, days):
    assert values(spark, [text], "s string", L.warranty_days(F.col("s"))) == [days]


def test_warranty_days_whole_zero(spark):
    texts = ["10 tháng", "20 năm", "0 tháng", "0", "không", "bảo hành 0 đồng 5 năm", "0012 ngày"]
    whole = L.warranty_days(F.col("s"), zero_rule="whole")
    assert values(spark, texts, "s string", whole) == [300, 7300, 0, 0, 0, 0, 12]
    with pytest.raises(ValueError, match="zero_rule"):
        L.warranty_days(F.col("s"), zero_rule="some")


def test_membership_days(spark):
    texts = [None, "", "3 năm", "3năm", "Đã tham gia 5 tháng", "2 NĂM", "9 ngày và 2 năm", "4\u00a0ngày", "x", "99999999999 năm"]
    assert values(spark, texts, "s string", L.membership_days(F.col("s"))) == [0, 0, 1095, 0, 150, 0, 9, 4, 0, 0]


def test_return_policy_label(spark):
    codes = ["any_reason", "defective_product", "no_return", None, "exchange_only"]
    assert values(spark, codes, "s string", L.return_policy_label(F.col("s"))) == [
        "Bất cứ lý do gì",
        "Sản phẩm hư hỏng",
        "Không đổi trả",
        "Không đổi trả",
        "exchange_only",
    ]


def test_missing_values(spark):
    assert values(spark, ["a", "", None], "s string", L.label_or_default(F.col("s"), "No Brand")) == ["a", "No Brand", "No Brand"]
    numbers = [1.9, float("nan"), None, 1e20]
    assert values(spark, numbers, "d double", L.int_or_zero(F.col("d"))) == [1, 0, 0, 0]
    assert values(spark, numbers, "d double", L.lenient_cast(F.col("d"), "int")) == [1, None, None, None]
    assert values(spark, ["12", "x", "", None], "s string", L.int_or_zero(F.col("s"))) == [12, 0, 0, 0]
    flags = ["true", "False", "1", "0", None, "maybe"]
    assert values(spark, flags, "s string", L.flag(F.col("s"))) == [True, False, True, False, None, None]


@pytest.mark.parametrize("to", ["int", "bigint", "double"])
def test_text_that_is_no_number_is_not_cast(spark, to):
    blank = ["", " ", "\t", "\x00", "\x1f", "\x7f", "\x85", "\xa0", "\u2028", "\u3000", "d"]
    numbers = ["1", "-7", "+3", "007", "4.5", ".5", "5.", "1e3", "1.E-3", "1d", "2F", "0x1p3", "0X1.8P-2", "NaN", "-inf", "Infinity", "1_0", "1,5", "\u0663", "9" * 19]
    texts = [None, "true", "none", "[1]", '{"a": 1}', "--1", "1 2", "0x", ".", "e", *[a + n + b for a in blank for n in numbers for b in blank]]
    got = values(spark, texts, "s string", L.lenient_cast(F.col("s"), to))
    assert list(map(repr, got)) == list(map(repr, values(spark, texts, "s string", F.col("s").try_cast(to))))
    plan = spark.createDataFrame([("x",)], "s string").select(L.lenient_cast(F.col("s"), to))._jdf.queryExecution().optimizedPlan().toString()
    assert "rlike" in plan.lower()
    assert values(spark, [2, None], "n int", L.lenient_cast(F.col("n"), to)) == [2, None]


def test_fill_subset(spark):
    df = spark.createDataFrame([(None, float("nan"), None), (2, 1.5, "x")], "n int, d double, s string")
    filled = df.transform(L.default_if_missing({"n": 0, "d": 0.0, "absent": 1}))
    assert [tuple(r) for r in filled.collect()] == [(0, 0.0, None), (2, 1.5, "x")]


def test_epoch_to_timestamp(spark):
    epochs = [0.0, 1700000000.75, float("nan"), None]
    expected = [dt.datetime(1970, 1, 1), dt.datetime(2023, 11, 14, 22, 13, 20), None, None]
    column = F.date_format(L.epoch_to_timestamp(F.col("d")), "yyyy-MM-dd HH:mm:ss.SSS")
    assert values(spark, epochs, "d double", column) == [e and e.strftime("%Y-%m-%d %H:%M:%S.000") for e in expected]


GROUPS = "g array<struct<attributes: array<struct<name: string, value: string>>>>"


def test_specification_text(spark):
    rows = [
        ([([("Màu", "đỏ"), ("Size", None)],), ([(None, "x")],)],),
        ([(None,), ([("A", "1")],)],),
        ([None, ([("A", "1")],)],),
        ([],),
        (None,),
    ]
    assert values(spark, rows, GROUPS, L.specification_text(F.col("g"))) == [
        "Màu: đỏ\nSize: \n: x",
        "A: 1",
        "A: 1",
        "",
        "",
    ]


def test_last_value_of(spark):
    rows = [
        ([("Thời gian bảo hành", "1 năm"), ("THỜI GIAN BẢO HÀNH", "2 năm"), ("Nơi bảo hành", "HN")],),
        ([None, ("Nơi bảo hành", "HN")],),
        ([("thời gian bảo hành", "1 năm"), ("thời gian bảo hành", None)],),
        ([],),
        (None,),
    ]
    entries = L.named_entries(F.col("w"))
    schema = "w array<struct<name: string, value: string>>"
    assert values(spark, rows, schema, L.last_value_of(entries, "thời_gian_bảo_hành")) == ["2 năm", None, None, None, None]
    assert values(spark, rows, schema, L.last_value_of(entries, "nơi_bảo_hành")) == ["HN", "HN", None, None, None]


def test_breadcrumbs(spark):
    rows = [([(1, "a"), (2, "b"), (3, "c")],), ([(1, "a")],), ([],), (None,)]
    schema = "b array<struct<category_id: bigint, name: string>>"
    assert values(spark, rows, schema, L.breadcrumb_path(F.col("b"))) == ["a / b", "", None, None]
    assert values(spark, rows, schema, L.category_of(F.col("b"))) == [1, 1, None, None]


def test_images_and_authors(spark):
    images = [([("u",), (None,)],), ([],), (None,)]
    assert values(spark, images, "i array<struct<base_url: string>>", L.image_urls(F.col("i"))) == [["u", None], [], []]
    authors = [([(1, "A")],), ([],), (None,)]
    found = values(spark, authors, "a array<struct<id: bigint, name: string>>", L.author_list(F.col("a")))
    assert [[tuple(p) for p in pairs] for pairs in found] == [[(1, "A")], [], []]


def test_json_text(spark):
    df = spark.createDataFrame([(("x", None), ["a"]), (None, None)], "s struct<a: string, b: int>, l array<string>")
    short = df.select(L.to_json_text(F.col("s")), L.to_json_text(F.col("l"))).collect()
    assert [tuple(r) for r in short] == [('{"a":"x"}', '["a"]'), (None, None)]
    full = df.select(L.to_json_text(F.col("s"), keep_null_fields=True)).first()[0]
    assert full == '{"a":"x","b":null}'


def test_links(spark):
    html = """
        <a href="/x" title="outside">o</a>
        <div class="other"><a title='wrong'></a></div>
        <DIV class="menu main"><div class="menu main"><a class=b
            TITLE='A &amp; "b" > c' HREF="/sach/c8322?x=1">t</a></div>
          <a data-title="no" href=/dien-gia-dung/c1882>u</a><a title="" href="/none">v</a><abbr title="no">w</abbr>
        </DIV>
        <!-- <a href="/comment"> --><script>"<a href='/script'>"</script >
        <div class="menu main"><a title="second menu"></a></div>
    """
    rows = [html, "", None, '<div class="menu main"><p><a title=open href=/o><div>', '<div class="menu main"></div><a title=x>']
    everything = values(spark, rows, "h string", L.anchor_links(F.col("h")))
    assert [tuple(x) for x in everything[0]] == [
        ("outside", "/x"),
        ("wrong", None),
        ('A & "b" > c', "/sach/c8322?x=1"),
        (None, "/dien-gia-dung/c1882"),
        ("", "/none"),
        ("second menu", None),
    ]
    assert everything[1:3] == [[], None]
    menu = values(spark, rows, "h string", L.titled(L.anchor_links(F.col("h"), "menu main")))
    assert [tuple(x) for x in menu[0]] == [('A & "b" > c', "/sach/c8322?x=1"), ("", "/none")]
    assert [[tuple(x) for x in found] for found in menu[1:]] == [[], [], [("open", "/o")], []]


def test_category_link_parts(spark):
    links = ["/nha-sach/c8322", "https://x.example/a/b-c/c12?p=1", "/none", "", None]
    assert values(spark, links, "s string", L.slug_of(F.col("s"))) == ["nha-sach", "b-c", None, None, None]
    assert values(spark, links, "s string", L.category_id_of(F.col("s"))) == [8322, 12, None, None, None]


def test_paths(spark):
    paths = ["root/a/b/c.json", "root/a/", "other", None]
    assert values(spark, paths, "s string", L.basename(F.col("s"))) == ["c.json", "", "other", None]
    assert values(spark, paths, "s string", L.strip_prefix(F.col("s"), "root/")) == ["a/b/c.json", "a/", "other", None]
    assert values(spark, paths, "s string", L.path_level(F.col("s"), 2)) == ["a", "a", None, None]
    row = [("sach", 1, 2, 3)]
    schema = "slug string, p bigint, s bigint, n int"
    parts = [F.col("slug"), F.col("p"), F.col("s")]
    assert values(spark, row, schema, L.document_path("product", *parts)) == ["sach/1_2/product_1_2.json"]
    assert values(spark, row, schema, L.document_path("seller", *parts)) == ["sach/1_2/seller_1_2.json"]
    assert values(spark, row, schema, L.document_path("reviews", *parts, F.col("n"))) == [
        "sach/1_2/reviews/reviews_1_2_3.json"
    ]
    with pytest.raises(ValueError, match="kind"):
        L.document_path("other", *parts)
    with pytest.raises(ValueError, match="page"):
        L.document_path("reviews", *parts)
