"""Product, seller, review and listing documents made from the given tables, row by row.

Each document comes from one row, so no group is ever gathered to build one.
The row's line number decides which parts of a document are missing, empty or
repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.operators.places import in_part, n_parts
from lakemart.queries.registry import Tables
from lakemart.schemas import PRODUCT_DOCUMENT, REVIEW_PAGE

# Type of the one field of a review page.
REVIEW_LIST = REVIEW_PAGE.partition(" data ")[2]

# id, seller, line, quantity, code, label, brand, amount, crawled

# Seconds at which a line was crawled; no two lines of a key have the same.
CRAWLED = """l_orderkey * 1000000 + (l_partkey * 7 + l_suppkey * 13 + l_linenumber * 1009 + CAST(l_quantity AS BIGINT) * 31
    + CAST(floor(l_extendedprice) AS BIGINT) * 17) % 1000000"""

OFFERS_SQL = f"""
    SELECT l_partkey AS id, l_suppkey AS seller, l_linenumber AS line, CAST(l_quantity AS INT) AS quantity,
           l_returnflag AS code, 'Item ' || l_partkey AS label, CAST(floor(l_extendedprice / 2000) AS BIGINT) AS brand,
           l_extendedprice AS amount, {CRAWLED} AS crawled
    FROM lineitem
"""

ORDERS_SQL = """
    SELECT o_orderkey AS id, o_custkey AS seller, TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS line,
           month(o_orderdate)::INT AS quantity, o_orderstatus AS code, o_orderpriority AS label,
           CAST(o_custkey AS BIGINT) AS brand, o_totalprice AS amount, o_orderkey AS crawled
    FROM orders
"""


def offers(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("id"),
        F.col("l_suppkey").alias("seller"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_returnflag").alias("code"),
        F.concat(F.lit("Item "), "l_partkey").alias("label"),
        F.floor(F.col("l_extendedprice") / 2000).cast("bigint").alias("brand"),
        F.col("l_extendedprice").alias("amount"),
        F.expr(CRAWLED).alias("crawled"),
    )


def orders_as_offers(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("seller"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("line"),
        F.month("o_orderdate").alias("quantity"),
        F.col("o_orderstatus").alias("code"),
        F.col("o_orderpriority").alias("label"),
        F.col("o_custkey").alias("brand"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderkey").alias("crawled"),
    )


def _entry(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))


def _crumb(number: Column, name: Column) -> Column:
    return F.struct(number.cast("bigint").alias("category_id"), name.alias("name"))


def _author(number: Column) -> Column:
    return F.struct(number.alias("id"), F.concat(F.lit("Author "), number).alias("name"))


def product_documents(rows: DataFrame) -> DataFrame:
    """Nested product documents from offer rows."""
    id_, seller, line, quantity = F.col("id"), F.col("seller"), F.col("line"), F.col("quantity")
    code, label, text = F.col("code"), F.col("label"), lambda *parts: F.concat(*parts)
    period = F.concat(quantity, F.lit(" tháng"))
    image = "array<struct<base_url: string>>"
    return rows.select(
        F.col("crawled").alias("crawled_at"),
        id_,
        text(F.lit("SKU-"), id_).alias("sku"),
        label.alias("name"),
        F.when(line != 7, text(F.lit("/p/"), id_)).alias("short_url"),
        F.when(line != 3, text(label, F.lit('\n"é" '), code)).alias("description"),
        F.when(line == 2, F.array().cast(image))
        .when(
            line > 2,
            F.transform(
                F.sequence(F.lit(1), line - 2),
                lambda i: F.struct(F.concat(F.lit("/img/"), id_, F.lit("/"), i, F.lit(".jpg")).alias("base_url")),
            ),
        )
        .alias("images"),
        F.col("amount").alias("list_price"),
        quantity.cast("double").alias("discount"),
        F.floor("amount").cast("double").alias("price"),
        line.cast("double").alias("discount_rate"),
        code.alias("inventory_status"),
        F.when(quantity > 25, F.lit("instock")).otherwise(F.lit("seller_backorder")).alias("inventory_type"),
        F.when(line != 4, quantity).cast("double").alias("all_time_quantity_sold"),
        quantity.cast("double").alias("day_ago_created"),
        (line / F.lit(2.0)).alias("rating_average"),
        F.when(line != 5, line).cast("double").alias("review_count"),
        F.when(
            line != 6,
            F.array(
                F.struct(
                    F.array(_entry("Màu", label), _entry("Size", F.when(line != 5, line))).alias("attributes")
                ),
                F.struct(
                    F.when(line > 1, F.array(_entry("Mã", code))).alias("attributes"),
                ),
            ),
        ).alias("specifications"),
        F.when(line == 2, F.array().cast("array<struct<category_id: bigint, name: string>>"))
        .when(line == 3, F.array(_crumb(quantity, F.lit("Home"))))
        .when(line > 3, F.array(_crumb(quantity, F.lit("Home")), _crumb(line, label), _crumb(id_, code)))
        .alias("breadcrumbs"),
        F.when(
            line != 7,
            F.struct(
                F.struct(
                    F.when(quantity > 10, F.lit("true")).otherwise(F.lit("false")).alias("is_authentic"),
                    F.when(quantity > 20, F.lit("1")).otherwise(F.lit("0")).alias("is_freeship_xtra"),
                    F.when(line != 6, F.lit("true")).alias("is_hero"),
                    F.when(quantity > 45, F.lit("true")).otherwise(F.lit("false")).alias("is_top_brand"),
                    F.when(line == 1, F.lit("any_reason"))
                    .when(line == 2, F.lit("defective_product"))
                    .when(line == 3, F.lit("no_return"))
                    .when(line == 4, F.lit("exchange_only"))
                    .alias("return_reason"),
                ).alias("amplitude")
            ),
        ).alias("tracking_info"),
        F.when(line == 4, F.struct(F.lit(None).cast("bigint").alias("id"), F.lit("").alias("name")))
        .when(line != 5, F.struct(F.col("brand").alias("id"), F.concat(F.lit("Brand "), F.col("brand")).alias("name")))
        .alias("brand"),
        F.when(line > 4, F.array(_author(seller), _author(seller + 1))).alias("authors"),
        F.struct(
            seller.alias("id"),
            (seller * 10).alias("store_id"),
            F.concat(F.lit("S"), seller).alias("sku"),
            F.concat(F.lit("Shop "), seller).alias("name"),
            F.lit(None).cast("string").alias("link"),
            F.concat(F.lit("/logo/"), seller).alias("logo"),
        ).alias("current_seller"),
        F.when(line == 2, F.array(_entry("Thời gian bảo hành", F.lit("3 năm")), _entry("thời gian BẢO HÀNH", period)))
        .when(line == 3, F.array(F.lit(None).cast("struct<name: string, value: string>"), _entry("Nơi bảo hành", label)))
        .when(line == 4, F.array(_entry("Hình thức bảo hành", F.lit("")), _entry("Thời gian bảo hành", F.lit("Trọn đời"))))
        .when(line > 4, F.array(_entry("Hình thức bảo hành", label), _entry("Thời gian bảo hành", F.concat(quantity, F.lit(" ngày")))))
        .alias("warranty_info"),
    ).to(StructType.fromDDL(PRODUCT_DOCUMENT))


# Silver product columns as the documents above define them, from a relation "source".
FLAT_SQL = r"""
    SELECT id AS product_id, 'SKU-' || id AS product_sku, label AS product_name,
           CASE WHEN line <> 7 THEN '/p/' || id END AS product_url,
           CASE WHEN line > 2 THEN list_transform(range(1, line - 1), lambda i: '/img/' || id || '/' || i || '.jpg')
                ELSE []::VARCHAR[] END AS images_url,
           CASE WHEN line <> 3 THEN label || chr(10) || '"é" ' || code END AS description,
           CAST(trunc(amount) AS BIGINT) AS original_price, CAST(quantity AS BIGINT) AS discount,
           CAST(floor(amount) AS BIGINT) AS price, line AS discount_rate, code AS inventory_status,
           CASE WHEN quantity > 25 THEN 'instock' ELSE 'seller_backorder' END AS inventory_type,
           CASE WHEN line <> 4 THEN quantity END AS quantity_sold, quantity AS day_ago_created,
           line / 2.0::DOUBLE AS rating_average, CASE WHEN line <> 5 THEN line END AS review_count,
           CASE WHEN line = 6 THEN ''
                ELSE 'Màu: ' || label || chr(10) || 'Size: ' || CASE WHEN line = 5 THEN '' ELSE line::VARCHAR END
                     || CASE WHEN line > 1 THEN chr(10) || 'Mã: ' || code ELSE '' END END AS specifications,
           CASE WHEN line = 3 THEN '' WHEN line > 3 THEN 'Home / ' || label END AS breadcrumbs,
           CASE WHEN line > 2 THEN CAST(quantity AS BIGINT) END AS category_id,
           CASE WHEN line <> 7 THEN quantity > 10 END AS is_authentic,
           CASE WHEN line <> 7 THEN quantity > 20 END AS is_freeship_xtra,
           CASE WHEN line NOT IN (6, 7) THEN true END AS is_top_deal,
           CASE WHEN line <> 7 THEN quantity > 45 END AS is_top_brand,
           CASE line WHEN 1 THEN 'any_reason' WHEN 2 THEN 'defective_product' WHEN 3 THEN 'no_return'
                     WHEN 4 THEN 'exchange_only' END AS return_reason,
           CASE WHEN line NOT IN (4, 5) THEN brand END AS brand_id,
           CASE WHEN line = 4 THEN '' WHEN line <> 5 THEN 'Brand ' || brand END AS brand_name,
           CASE WHEN line > 4 THEN [{'author_id': seller, 'author_name': 'Author ' || seller},
                                    {'author_id': seller + 1, 'author_name': 'Author ' || (seller + 1)}]
                ELSE [] END AS authors,
           seller * 10 AS store_id, seller AS seller_id, 'S' || seller AS seller_sku, 'Shop ' || seller AS seller_name,
           NULL::VARCHAR AS seller_url, '/logo/' || seller AS seller_logo,
           CASE WHEN line = 2 THEN quantity || ' tháng' WHEN line = 4 THEN 'Trọn đời'
                WHEN line > 4 THEN quantity || ' ngày' END AS warranty_period,
           CASE WHEN line = 4 THEN '' WHEN line > 4 THEN label END AS warranty_type,
           CASE WHEN line = 3 THEN label END AS warranty_location
    FROM source
"""

# Lists as text, in the way both engines agree on.
LISTS_AS_TEXT_SQL = """
    * REPLACE (array_to_string(images_url, ' ') AS images_url,
               array_to_string(list_transform(authors, lambda a: a.author_id || '=' || a.author_name), ' ') AS authors)
"""


def lists_as_text(products: DataFrame) -> DataFrame:
    replaced = {
        "images_url": F.array_join("images_url", " "),
        "authors": F.array_join(
            F.transform("authors", lambda a: F.concat_ws("=", a["author_id"], a["author_name"])), " "
        ),
    }
    return products.withColumns({name: column for name, column in replaced.items() if name in products.columns})


# One silver product per offer, from its newest crawl, of sellers in good standing.
SILVER_SQL = f"""
    WITH source AS ({OFFERS_SQL}),
    flat AS ({FLAT_SQL.replace("FROM source", ", crawled FROM source")}),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY product_id, seller_id ORDER BY crawled DESC) AS rn FROM flat),
    silver AS (
        SELECT * EXCLUDE (rn, crawled) REPLACE (
            coalesce(brand_id, 0) AS brand_id,
            coalesce(nullif(brand_name, ''), 'No Brand') AS brand_name,
            coalesce(nullif(warranty_type, ''), 'Không bảo hành') AS warranty_type,
            coalesce(nullif(warranty_location, ''), 'Không bảo hành') AS warranty_location,
            coalesce(quantity_sold, 0) AS quantity_sold),
            CASE WHEN warranty_period = 'Trọn đời' THEN 36500
                 WHEN warranty_period IS NULL OR contains(warranty_period, '0') THEN 0
                 WHEN contains(warranty_period, 'tháng') THEN CAST(string_split(warranty_period, ' ')[1] AS INT) * 30
                 ELSE CAST(string_split(warranty_period, ' ')[1] AS INT) END AS warranty_period_days,
            CASE coalesce(return_reason, 'no_return') WHEN 'any_reason' THEN 'Bất cứ lý do gì'
                 WHEN 'defective_product' THEN 'Sản phẩm hư hỏng' WHEN 'no_return' THEN 'Không đổi trả'
                 ELSE return_reason END AS return_policy
        FROM ranked
        WHERE rn = 1 AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = seller_id AND s_acctbal >= 4000))
"""


def seller_documents(t: Tables) -> DataFrame:
    """Seller documents: some without a seller, some with missing counters, every seller on two documents."""
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    seller = F.struct(
        key.alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("/icon/"), key).alias("icon"),
        F.concat(F.lit("/shop/"), key).alias("url"),
        F.when(balance >= 2000, balance).alias("avg_rating_point"),
        F.when(balance >= 4000, F.floor(balance)).cast("double").alias("review_count"),
        (F.col("s_nationkey") * 10 + F.col("copy")).cast("double").alias("total_follower"),
        F.when(F.col("s_nationkey") != 3, F.col("s_nationkey")).cast("double").alias("days_since_joined"),
        F.when(balance >= 6000, F.lit("true")).when(balance >= 3000, F.lit("0")).alias("is_official"),
        F.when(balance >= 6000, F.lit("OFFICIAL_STORE")).otherwise(F.lit("NONE")).alias("store_level"),
    )
    copies = t.supplier.withColumn("copy", F.explode(F.array(F.lit(2), F.lit(1))))
    crawled = F.lit(1_700_000_000) + F.col("copy")
    return copies.select(crawled.cast("bigint").alias("crawled_at"), F.struct(F.when(balance >= 0, seller).alias("seller")).alias("data"))


SELLERS_SQL = """
    SELECT s_suppkey AS seller_id, s_name AS seller_name, '/icon/' || s_suppkey AS icon_url,
           '/shop/' || s_suppkey AS store_url,
           CASE WHEN s_acctbal >= 2000 THEN s_acctbal END AS avg_rating_point,
           CASE WHEN s_acctbal >= 4000 THEN CAST(floor(s_acctbal) AS INT) END AS review_count,
           s_nationkey * 10 + copy AS total_follower,
           CASE WHEN s_nationkey <> 3 THEN s_nationkey END AS days_since_joined,
           CASE WHEN s_acctbal >= 6000 THEN true WHEN s_acctbal >= 3000 THEN false END AS is_official,
           CASE WHEN s_acctbal >= 6000 THEN 'OFFICIAL_STORE' ELSE 'NONE' END AS store_level
    FROM supplier, (VALUES (1), (2)) c(copy) WHERE s_acctbal >= 0
"""

SILVER_SELLERS_SQL = f"""
    SELECT * REPLACE (coalesce(avg_rating_point, 0.0) AS avg_rating_point, coalesce(review_count, 0) AS review_count,
                      coalesce(days_since_joined, 0) AS days_since_joined)
    FROM ({SELLERS_SQL}) WHERE seller_id <> 0
    QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY total_follower DESC) = 1
"""


def _days_epoch(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01")).cast("double") * 86400


def review_pages(t: Tables, part: int = 0, parts: int = 1) -> DataFrame:
    """A review page per order line, or those of one part of the orders: odd lines hold a second review without author, whose id other pages repeat."""
    line = F.col("l_linenumber")
    product, seller = F.col("l_partkey"), F.struct(F.col("l_suppkey").alias("id"))
    author = F.struct(
        F.concat(F.lit("Customer "), F.col("o_custkey")).alias("full_name"),
        F.when(line != 5, _days_epoch(F.col("l_shipdate"))).alias("purchased_at"),
        F.when(line != 6, F.concat(F.lit("/avatar/"), F.col("o_custkey"))).alias("avatar_url"),
        F.struct(
            F.struct(
                F.when(line == 1, F.concat(F.lit("Đã tham gia "), line, F.lit(" năm")))
                .when(line == 2, F.concat(F.col("l_quantity").cast("int"), F.lit(" ngày")))
                .when(line == 3, F.lit("2tháng"))
                .alias("joined_time"),
                F.when(line != 4, line).cast("double").alias("total_review"),
                F.when(line != 4, F.col("l_quantity")).alias("total_thank"),
            ).alias("summary")
        ).alias("contribute_info"),
    )

    def review(number: Column, written_by: Column) -> Column:
        return F.struct(
            number.alias("id"),
            product.alias("product_id"),
            F.when(line != 7, seller).alias("seller"),
            F.col("l_returnflag").alias("title"),
            F.concat(F.lit("nội dung\n"), line).alias("content"),
            F.col("o_orderstatus").alias("status"),
            line.cast("double").alias("thank_count"),
            F.lit(5.0).alias("rating"),
            _days_epoch(F.col("o_orderdate")).alias("created_at"),
            F.when(line != 6, F.col("o_custkey")).alias("customer_id"),
            written_by.alias("created_by"),
        )

    first = review(F.col("l_orderkey") * 10 + line, author)
    second = review(F.col("l_orderkey") * 10, F.when(F.lit(False), author))
    lines = t.lineitem.filter(in_part(["l_orderkey"], part, parts))
    rows = lines.join(t.orders.filter(in_part(["o_orderkey"], part, parts)), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        F.expr(CRAWLED).alias("crawled_at"),
        F.when(line.isin(1, 3, 5), F.array(first, second))
        .when(line == 7, F.array(first.withField("created_by", F.when(F.lit(False), author))))
        .when(line != 4, F.array(first))
        .when(F.col("l_returnflag") != "R", F.array(first))
        .otherwise(F.array().cast(REVIEW_LIST))
        .alias("data")
    )


def review_pages_in_parts(t: Tables) -> Iterator[DataFrame]:
    """All review pages as frames to be run one after the other, so that the join of one part at a time lies in shuffle files."""
    parts = n_parts(t.lineitem.count())
    return (review_pages(t, part, parts) for part in range(parts))


REVIEWS_SQL = """
    SELECT l_orderkey * 10 + CASE WHEN second THEN 0 ELSE l_linenumber END AS review_id, l_partkey AS product_id,
           CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS seller_id, l_returnflag AS title,
           'nội dung' || chr(10) || l_linenumber AS content, o_orderstatus AS status, l_linenumber AS thank_count,
           5 AS rating, epoch_us(o_orderdate) // 1000000 AS created_at,
           CASE WHEN l_linenumber <> 6 THEN o_custkey END AS customer_id,
           CASE WHEN written THEN 'Customer ' || o_custkey END AS customer_name,
           CASE WHEN written AND l_linenumber <> 5 THEN epoch_us(l_shipdate) // 1000000 END AS purchased_at,
           CASE WHEN written AND l_linenumber <> 6 THEN '/avatar/' || o_custkey END AS avatar_url,
           CASE WHEN written THEN CASE l_linenumber WHEN 1 THEN 'Đã tham gia 1 năm'
                WHEN 2 THEN CAST(l_quantity AS INT) || ' ngày' WHEN 3 THEN '2tháng' END END AS joined_time,
           CASE WHEN written AND l_linenumber <> 4 THEN l_linenumber ELSE 0 END AS total_review,
           CASE WHEN written AND l_linenumber <> 4 THEN CAST(l_quantity AS INT) ELSE 0 END AS total_thank
    FROM (SELECT *, NOT second AND l_linenumber <> 7 AS written
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey, (VALUES (false), (true)) s(second)
          WHERE (NOT second AND (l_linenumber <> 4 OR l_returnflag <> 'R')) OR (second AND l_linenumber IN (1, 3, 5)))
"""

# Offers reviewed: those returned or awaiting return.
SILVER_REVIEWS_SQL = f"""
    WITH flat AS ({REVIEWS_SQL.replace("    FROM (SELECT *, NOT", f", {CRAWLED} AS crawled FROM (SELECT *, NOT")}),
    known AS (
        SELECT * FROM flat f WHERE EXISTS (
            SELECT 1 FROM lineitem p WHERE p.l_returnflag <> 'N' AND p.l_partkey = f.product_id AND p.l_suppkey = f.seller_id)),
    silver AS (
        SELECT * EXCLUDE (rn, crawled), make_timestamp(created_at * 1000000) AS created_ts,
               make_timestamp(purchased_at * 1000000) AS purchased_ts,
               CASE WHEN joined_time LIKE '%1 năm' THEN 365
                    WHEN joined_time LIKE '% ngày' THEN CAST(string_split(joined_time, ' ')[1] AS INT) ELSE 0 END AS joined_days
        FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY crawled DESC) AS rn
              FROM known)
        WHERE rn = 1)
"""


def times_without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock times, whatever the session zone."""
    return df.withColumns(
        {
            name: F.convert_timezone(None, F.lit("UTC"), F.col(name).cast("timestamp_ntz"))
            for name, type_ in df.dtypes
            if type_ == "timestamp"
        }
    )
