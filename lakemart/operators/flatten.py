"""Nested documents to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart import fixed
from lakemart.functions import (
    author_list,
    breadcrumb_path,
    category_of,
    flag,
    image_urls,
    last_value_of,
    lenient_cast,
    named_entries,
    specification_text,
    whole_number,
)


def _long(path: str) -> Column:
    return whole_number(F.col(path))


def _int(path: str) -> Column:
    return whole_number(F.col(path), "int")


def _double(path: str) -> Column:
    return lenient_cast(F.col(path), "double")


def product_seller() -> Column:
    """Seller of a product document."""
    return _long("current_seller.id")


def flatten_products(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per product document (P1-P3); columns named in ``carry`` come along at the end."""
    warranty = F.col("_warranty")
    amplitude = "tracking_info.amplitude"
    # A column of its own, so that the three lookups share one pass over the list.
    return documents.withColumn("_warranty", named_entries(F.col("warranty_info"))).select(
        _long("id").alias("product_id"),
        F.col("sku").alias("product_sku"),
        F.col("name").alias("product_name"),
        F.col("short_url").alias("product_url"),
        image_urls(F.col("images")).alias("images_url"),
        F.col("description"),
        _long("list_price").alias("original_price"),
        _long("discount").alias("discount"),
        _long("price").alias("price"),
        _int("discount_rate").alias("discount_rate"),
        F.col("inventory_status"),
        F.col("inventory_type"),
        _int("all_time_quantity_sold").alias("quantity_sold"),
        _int("day_ago_created").alias("day_ago_created"),
        _double("rating_average").alias("rating_average"),
        _int("review_count").alias("review_count"),
        specification_text(F.col("specifications")).alias("specifications"),
        breadcrumb_path(F.col("breadcrumbs")).alias("breadcrumbs"),
        whole_number(category_of(F.col("breadcrumbs"))).alias("category_id"),
        flag(F.col(f"{amplitude}.is_authentic")).alias("is_authentic"),
        flag(F.col(f"{amplitude}.is_freeship_xtra")).alias("is_freeship_xtra"),
        flag(F.col(f"{amplitude}.is_hero")).alias("is_top_deal"),
        flag(F.col(f"{amplitude}.is_top_brand")).alias("is_top_brand"),
        F.col(f"{amplitude}.return_reason").alias("return_reason"),
        _long("brand.id").alias("brand_id"),
        F.col("brand.name").alias("brand_name"),
        author_list(F.col("authors")).alias("authors"),
        _long("current_seller.store_id").alias("store_id"),
        product_seller().alias("seller_id"),
        F.col("current_seller.sku").alias("seller_sku"),
        F.col("current_seller.name").alias("seller_name"),
        F.col("current_seller.link").alias("seller_url"),
        F.col("current_seller.logo").alias("seller_logo"),
        last_value_of(warranty, fixed.WARRANTY_PERIOD).alias("warranty_period"),
        last_value_of(warranty, fixed.WARRANTY_TYPE).alias("warranty_type"),
        last_value_of(warranty, fixed.WARRANTY_LOCATION).alias("warranty_location"),
        *carry,
    )


def flatten_sellers(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document that holds a seller (P4); ``carry`` as for products."""
    seller = "data.seller"
    fields = ["id", "name", "icon", "url", "avg_rating_point", "review_count", "total_follower"]
    fields += ["days_since_joined", "is_official", "store_level"]
    # An empty object is no seller either.
    any_field = F.coalesce(*[F.col(f"{seller}.{field}").cast("string") for field in fields])
    return documents.filter(any_field.isNotNull()).select(
        _long(f"{seller}.id").alias("seller_id"),
        F.col(f"{seller}.name").alias("seller_name"),
        F.col(f"{seller}.icon").alias("icon_url"),
        F.col(f"{seller}.url").alias("store_url"),
        _double(f"{seller}.avg_rating_point").alias("avg_rating_point"),
        _int(f"{seller}.review_count").alias("review_count"),
        _int(f"{seller}.total_follower").alias("total_follower"),
        _int(f"{seller}.days_since_joined").alias("days_since_joined"),
        flag(F.col(f"{seller}.is_official")).alias("is_official"),
        F.col(f"{seller}.store_level").alias("store_level"),
        *carry,
    )


def flatten_reviews(pages: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per review of every page; an absent author has NULLs and zero counts (P5).

    Columns of the page named in ``carry`` come along at the end.
    """
    summary = "r.created_by.contribute_info.summary"
    return (
        pages.select(F.explode("data").alias("r"), *carry)
        .filter(F.col("r").isNotNull())
        .select(
            _long("r.id").alias("review_id"),
            _long("r.product_id").alias("product_id"),
            _long("r.seller.id").alias("seller_id"),
            F.col("r.title").alias("title"),
            F.col("r.content").alias("content"),
            F.col("r.status").alias("status"),
            _int("r.thank_count").alias("thank_count"),
            _int("r.rating").alias("rating"),
            _long("r.created_at").alias("created_at"),
            _long("r.customer_id").alias("customer_id"),
            F.col("r.created_by.full_name").alias("customer_name"),
            _long("r.created_by.purchased_at").alias("purchased_at"),
            F.col("r.created_by.avatar_url").alias("avatar_url"),
            F.col(f"{summary}.joined_time").alias("joined_time"),
            F.coalesce(_int(f"{summary}.total_review"), F.lit(0)).alias("total_review"),
            F.coalesce(_int(f"{summary}.total_thank"), F.lit(0)).alias("total_thank"),
            *carry,
        )
    )


def flatten_listing(pages: DataFrame, category_id: Column, slug: Column) -> DataFrame:
    """One row per listed product, in ledger columns (P6); category and slug are columns or literals of the page."""
    return (
        pages.select(F.explode("data").alias("d"), category_id.alias("category_id"), slug.alias("slug"))
        .filter(F.col("d").isNotNull())
        .select(
            F.col("d.id").alias("pid"),
            F.col("d.seller_product_id").alias("spid"),
            F.col("d.seller_id").alias("seller_id"),
            "category_id",
            "slug",
        )
    )
