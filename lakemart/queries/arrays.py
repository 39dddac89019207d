"""Nested values: lists, key lookups, explodes and JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import (
    author_list,
    breadcrumb_path,
    category_of,
    image_urls,
    last_value_of,
    named_entries,
    specification_text,
)
from lakemart.operators import flatten_listing, flatten_products, flatten_reviews, flatten_sellers
from lakemart.plans import gold
from lakemart.queries import documents
from lakemart.queries.registry import Tables, query
from lakemart.schemas import REVIEW_PAGE
from lakemart.sources.jdbc import prepare_for_jdbc

_FLAT_OFFERS = f"WITH source AS ({documents.OFFERS_SQL}), flat AS ({documents.FLAT_SQL})"


@query("E3", f"{_FLAT_OFFERS} SELECT product_id, seller_id, price, specifications FROM flat")
def specs_join(t: Tables) -> DataFrame:
    docs = documents.product_documents(documents.offers(t))
    return docs.select(
        F.col("id").alias("product_id"),
        F.col("current_seller.id").alias("seller_id"),
        F.col("price").cast("bigint").alias("price"),
        specification_text(F.col("specifications")).alias("specifications"),
    )


@query(
    "E4", f"{_FLAT_OFFERS} SELECT product_id, seller_id, warranty_period, warranty_type, warranty_location FROM flat"
)
def kv_last_wins(t: Tables) -> DataFrame:
    docs = documents.product_documents(documents.offers(t)).withColumn(
        "entries", named_entries(F.col("warranty_info"))
    )
    entries = F.col("entries")
    return docs.select(
        F.col("id").alias("product_id"),
        F.col("current_seller.id").alias("seller_id"),
        last_value_of(entries, "thời_gian_bảo_hành").alias("warranty_period"),
        last_value_of(entries, "hình_thức_bảo_hành").alias("warranty_type"),
        last_value_of(entries, "nơi_bảo_hành").alias("warranty_location"),
    )


@query("E5 E6", f"{_FLAT_OFFERS} SELECT product_id, seller_id, breadcrumbs, category_id FROM flat")
def breadcrumb_join(t: Tables) -> DataFrame:
    docs = documents.product_documents(documents.offers(t))
    return docs.select(
        F.col("id").alias("product_id"),
        F.col("current_seller.id").alias("seller_id"),
        breadcrumb_path(F.col("breadcrumbs")).alias("breadcrumbs"),
        category_of(F.col("breadcrumbs")).alias("category_id"),
    )


@query(
    "E7 E8",
    f"""{_FLAT_OFFERS}
    SELECT product_id, array_to_string(images_url, ' ') AS images_url, len(images_url)::INT AS n_images,
           array_to_string(list_transform(authors, lambda a: a.author_id || '=' || a.author_name), ' ') AS authors FROM flat
    """,
)
def array_project(t: Tables) -> DataFrame:
    docs = documents.product_documents(documents.offers(t))
    lists = docs.select(
        F.col("id").alias("product_id"),
        image_urls(F.col("images")).alias("images_url"),
        author_list(F.col("authors")).alias("authors"),
    )
    return documents.lists_as_text(lists.withColumn("n_images", F.size("images_url")))


@query(
    "E9 P8 X1 A4",
    f"{_FLAT_OFFERS} SELECT DISTINCT product_id, unnest(authors).author_id AS author_id FROM flat",
)
def explode_authors(t: Tables) -> DataFrame:
    return gold.product_authors(flatten_products(documents.product_documents(documents.offers(t))))


@query("X2 E7 E9", f"{_FLAT_OFFERS} SELECT product_id, seller_id, unnest(images_url) AS image_url FROM flat")
def check_image_urls(t: Tables) -> DataFrame:
    return gold.product_images(flatten_products(documents.product_documents(documents.offers(t))))


@query(
    "K4 E16",
    """
    SELECT o_orderkey,
           '{"status":"' || o_orderstatus || '"'
             || CASE WHEN o_orderstatus <> 'P' THEN ',"customer":' || o_custkey ELSE '' END || '}' AS header,
           CASE WHEN o_orderpriority <> '5-LOW' THEN '["' || o_orderpriority || '","' || o_orderstatus || '"]' END AS tags,
           '{"' || o_orderstatus || '":' || o_custkey || '}' AS by_status
    FROM orders
    """,
)
def complex_to_json(t: Tables) -> DataFrame:
    customer = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    nested = t.orders.select(
        "o_orderkey",
        F.struct(F.col("o_orderstatus").alias("status"), customer.alias("customer")).alias("header"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.array("o_orderpriority", "o_orderstatus")).alias("tags"),
        F.create_map("o_orderstatus", "o_custkey").alias("by_status"),
    )
    return prepare_for_jdbc(nested)


@query(
    "P1 P2 P3 E3 E4 E5 E6 E7 E8",
    f"{_FLAT_OFFERS} SELECT {documents.LISTS_AS_TEXT_SQL} FROM flat",
)
def product_flatten(t: Tables) -> DataFrame:
    return documents.lists_as_text(flatten_products(documents.product_documents(documents.offers(t))))


@query("P4", documents.SELLERS_SQL)
def seller_flatten(t: Tables) -> DataFrame:
    return flatten_sellers(documents.seller_documents(t))


@query("P5 E9 E23", documents.REVIEWS_SQL)
def review_page_flatten(t: Tables) -> DataFrame:
    return flatten_reviews(documents.review_pages(t))


@query(
    "P5 E9",
    r"""
    SELECT conv_id * 1000 + turn AS review_id, conv_id AS product_id, turn AS seller_id, role AS title,
           unnest(string_split(text, chr(10))) AS content, 0 AS total_review, 0 AS total_thank
    FROM conversations
    """,
)
def review_lines_flatten(t: Tables) -> DataFrame:
    pages = t.conversations.select(
        F.transform(
            F.split("text", "\n"),
            lambda text: F.struct(
                (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
                F.col("conv_id").alias("product_id"),
                F.struct(F.col("turn").alias("id")).alias("seller"),
                F.col("role").alias("title"),
                text.alias("content"),
            ),
        ).alias("data")
    ).select(F.from_json(F.to_json(F.struct("data")), REVIEW_PAGE).alias("page"))
    return flatten_reviews(pages.select("page.data")).select(
        "review_id", "product_id", "seller_id", "title", "content", "total_review", "total_thank"
    )


@query(
    "P6 E9",
    """
    SELECT p_partkey + 10 * i AS pid, p_partkey * i AS spid, CASE WHEN p_size > 25 THEN CAST(p_size AS BIGINT) END AS seller_id,
           CAST(p_size AS BIGINT) AS category_id, p_type AS slug
    FROM (SELECT *, unnest(range(1, (CASE WHEN p_size > 40 THEN 0 WHEN p_size > 10 THEN 3 ELSE 1 END) + 1)) AS i FROM part)
    """,
)
def listing_flatten(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("bigint")
    entries = F.when(size > 40, F.array().cast("array<int>")).when(
        size > 10, F.sequence(F.lit(1), F.lit(3))
    ).otherwise(F.array(F.lit(1)))
    pages = t.part.select(
        F.transform(
            entries,
            lambda i: F.struct(
                (F.col("p_partkey") + 10 * i).alias("id"),
                (F.col("p_partkey") * i).alias("seller_product_id"),
                F.when(size > 25, size).alias("seller_id"),
            ),
        ).alias("data"),
        size.alias("category"),
        "p_type",
    )
    return flatten_listing(pages, F.col("category"), F.col("p_type"))
