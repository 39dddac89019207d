"""Schemas and declared keys of every layer.

The document schemas name the types that sources mean.  Documents are scanned
with every scalar as text (:func:`scalars_as_text`) and cast on flattening, so
that an odd scalar is a NULL in its field and nothing more.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

CORRUPT = "_corrupt_record"


def scalars_as_text(ddl: str) -> str:
    """The same schema with its numbers as strings."""
    return re.sub(r"\b(?:bigint|double)\b", "string", ddl)


#: When a document was crawled, in seconds; documents without it go by the time of their file.
CRAWLED_AT = "crawled_at"

PRODUCT_DOCUMENT = """
    crawled_at bigint, id bigint, sku string, name string, short_url string, description string,
    images array<struct<base_url: string>>,
    list_price double, discount double, price double, discount_rate double,
    inventory_status string, inventory_type string,
    all_time_quantity_sold double, day_ago_created double, rating_average double, review_count double,
    specifications array<struct<attributes: array<struct<name: string, value: string>>>>,
    breadcrumbs array<struct<category_id: bigint, name: string>>,
    tracking_info struct<amplitude: struct<
        is_authentic: string, is_freeship_xtra: string, is_hero: string, is_top_brand: string, return_reason: string>>,
    brand struct<id: bigint, name: string>,
    authors array<struct<id: bigint, name: string>>,
    current_seller struct<id: bigint, store_id: bigint, sku: string, name: string, link: string, logo: string>,
    warranty_info array<struct<name: string, value: string>>
"""

SELLER_DOCUMENT = """
    crawled_at bigint, data struct<seller: struct<
        id: bigint, name: string, icon: string, url: string, avg_rating_point: double,
        review_count: double, total_follower: double, days_since_joined: double,
        is_official: string, store_level: string>>
"""

REVIEW_PAGE = """
    crawled_at bigint, data array<struct<
        id: bigint, product_id: bigint, seller: struct<id: bigint>, title: string, content: string, status: string,
        thank_count: double, rating: double, created_at: double, customer_id: bigint,
        created_by: struct<
            full_name: string, purchased_at: double, avatar_url: string,
            contribute_info: struct<summary: struct<joined_time: string, total_review: double, total_thank: double>>>>>
"""

LISTING_PAGE = "data array<struct<id: bigint, seller_product_id: bigint, seller_id: bigint>>"

CATEGORIES_CSV = "title string, slug string, category_id bigint"

LEDGER = "pid bigint, spid bigint, seller_id bigint, category_id bigint, slug string"


@dataclass(frozen=True)
class Table:
    """Declared columns and keys of a gold table; the keys are checked by jobs, not by the storage."""

    name: str
    columns: dict[str, str]
    primary_key: tuple[str, ...]
    foreign_keys: tuple[tuple[tuple[str, ...], str], ...] = ()

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {type_}" for name, type_ in self.columns.items())


_TABLES = (
    Table("categories", {"category_id": "bigint", "slug": "string", "title": "string"}, ("category_id",)),
    Table("brands", {"brand_id": "bigint", "brand_name": "string", "is_top_brand": "boolean"}, ("brand_id",)),
    Table("authors", {"author_id": "bigint", "author_name": "string"}, ("author_id",)),
    Table(
        "sellers",
        {
            "seller_id": "bigint",
            "seller_name": "string",
            "icon_url": "string",
            "avg_rating_point": "double",
            "review_count": "int",
            "total_follower": "int",
            "days_since_joined": "int",
            "is_official": "boolean",
            "store_level": "string",
        },
        ("seller_id",),
    ),
    Table(
        "products",
        {
            "product_id": "bigint",
            "seller_id": "bigint",
            "product_sku": "string",
            "product_name": "string",
            "product_url": "string",
            "images_url": "array<string>",
            "description": "string",
            "price": "bigint",
            "discount_rate": "int",
            "inventory_status": "string",
            "inventory_type": "string",
            "quantity_sold": "int",
            "rating_average": "double",
            "review_count": "int",
            "specifications": "string",
            "breadcrumbs": "string",
            "category_id": "bigint",
            "is_authentic": "boolean",
            "is_freeship_xtra": "boolean",
            "is_top_deal": "boolean",
            "return_reason": "string",
            "brand_id": "bigint",
            "authors": "array<struct<author_id: bigint, author_name: string>>",
            "warranty_type": "string",
            "warranty_location": "string",
            "warranty_period_days": "int",
            "return_policy": "string",
        },
        ("product_id",),
        ((("seller_id",), "sellers"), (("category_id",), "categories"), (("brand_id",), "brands")),
    ),
    Table(
        "reviews",
        {
            "review_id": "bigint",
            "title": "string",
            "content": "string",
            "status": "string",
            "rating": "int",
            "product_id": "bigint",
            "seller_id": "bigint",
        },
        ("review_id",),
        ((("product_id",), "products"), (("seller_id",), "sellers")),
    ),
    Table(
        "customers",
        {
            "customer_id": "bigint",
            "customer_name": "string",
            "avatar_url": "string",
            "total_review": "int",
            "total_thank": "int",
            "joined_day": "int",
        },
        ("customer_id",),
    ),
    Table(
        "customer_review",
        {"customer_id": "bigint", "review_id": "bigint", "created_ts": "timestamp"},
        ("customer_id", "review_id"),
        ((("customer_id",), "customers"), (("review_id",), "reviews")),
    ),
    Table(
        "customer_purchase",
        {"customer_id": "bigint", "product_id": "bigint", "seller_id": "bigint", "purchased_ts": "timestamp"},
        ("customer_id", "product_id", "seller_id"),
        ((("customer_id",), "customers"), (("product_id",), "products"), (("seller_id",), "sellers")),
    ),
)

GOLD = {table.name: table for table in _TABLES}
