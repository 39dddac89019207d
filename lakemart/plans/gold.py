"""Silver to gold."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import fixed
from lakemart.operators.dedup import keep_one
from lakemart.operators.filters import has_id, present
from lakemart.operators.project import select_existing
from lakemart.plans.report import TableReport, guarded, publish
from lakemart.schemas import GOLD
from lakemart.sources.paths import Lake
from lakemart.sources.readers import read_required


def gold_products(products: DataFrame) -> DataFrame:
    return select_existing(products, list(GOLD["products"].columns))


def _authorship(products: DataFrame) -> DataFrame:
    """One row per offer and author."""
    return (
        products.filter(present("authors"))
        .select("product_id", F.explode("authors").alias("author"))
        .select("product_id", F.col("author.author_id"), F.col("author.author_name"))
        .filter(present("author_id"))
    )


def gold_authors(products: DataFrame) -> DataFrame:
    return keep_one(_authorship(products).select("author_id", "author_name"), ["author_id"])


def product_authors(products: DataFrame) -> DataFrame:
    """Product to author mapping."""
    return _authorship(products).select("product_id", "author_id").distinct()


def product_images(products: DataFrame) -> DataFrame:
    """One row per image address of an offer."""
    return products.select("product_id", "seller_id", F.explode("images_url").alias("image_url"))


def gold_brands(products: DataFrame) -> DataFrame:
    """One row per brand: first name, top brand if any of its products says so.

    Grouped by brand and name first: equal pairs collapse before the shuffle
    with a hash aggregate, and what is left to merge per brand are its names.
    """
    brands = products.filter(has_id("brand_id"))
    if "is_top_brand" not in brands.columns:
        brands = brands.withColumn("is_top_brand", F.lit(None).cast("boolean"))
    named = brands.groupBy("brand_id", "brand_name").agg(F.bool_or("is_top_brand").alias("is_top_brand"))
    return named.groupBy("brand_id").agg(
        F.min("brand_name").alias("brand_name"), F.bool_or("is_top_brand").alias("is_top_brand")
    )


def gold_reviews(reviews: DataFrame) -> DataFrame:
    return select_existing(reviews, list(GOLD["reviews"].columns))


def gold_customers(reviews: DataFrame) -> DataFrame:
    """One row per customer, as in the latest review that names them."""
    known = reviews.withColumnRenamed("joined_days", "joined_day").filter(present("customer_id"))
    preferences = {
        "customer_name": F.col("customer_name").isNull().asc(),
        "created_ts": F.col("created_ts").desc_nulls_last(),
    }
    order = [preference for name, preference in preferences.items() if name in known.columns]
    wanted = list(GOLD["customers"].columns)
    latest = keep_one(select_existing(known, [*wanted, "created_ts"]), ["customer_id"], order)
    return latest.drop("created_ts")


def customer_review(reviews: DataFrame) -> DataFrame:
    """Customer to review link with the earliest time."""
    keys = ["customer_id", "review_id"]
    return reviews.filter(present(*keys)).groupBy(*keys).agg(F.min("created_ts").alias("created_ts"))


def customer_purchase(reviews: DataFrame) -> DataFrame:
    """Distinct purchases seen in reviews."""
    return (
        reviews.filter(present("customer_id", "product_id"))
        .select(*GOLD["customer_purchase"].columns)
        .distinct()
    )


def gold_categories(categories: DataFrame) -> DataFrame:
    """Categories as they are."""
    return categories


def gold_sellers(sellers: DataFrame) -> DataFrame:
    return select_existing(sellers, list(GOLD["sellers"].columns))


# Output table -> (silver source, columns it cannot do without, builder)
OUTPUTS: dict[str, tuple[str, tuple[str, ...], Callable[[DataFrame], DataFrame]]] = {
    "products": ("products", (), gold_products),
    "authors": ("products", ("authors",), gold_authors),
    "brands": ("products", ("brand_id",), gold_brands),
    "products_authors": ("products", ("authors",), product_authors),
    "images_url": ("products", ("images_url",), product_images),
    "reviews": ("reviews", (), gold_reviews),
    "customers": ("reviews", ("customer_id",), gold_customers),
    "customer_review": ("reviews", ("customer_id", "review_id", "created_ts"), customer_review),
    "customer_purchase": ("reviews", tuple(GOLD["customer_purchase"].columns), customer_purchase),
    "categories": ("categories", (), gold_categories),
    "sellers": ("sellers", (), gold_sellers),
}


def build_outputs(silver: DataFrame | None, source: str, lake: Lake, only: Collection[str] | None = None) -> list[TableReport]:
    """Every gold table of one silver table, or those named by ``only``.

    An output whose source column is absent is skipped (P12), one that fails
    does not stop the rest (R2).  Each output scans only its own columns.
    """
    reports = []
    for table, (from_, needed, build) in OUTPUTS.items():
        if from_ != source or (only is not None and table not in only):
            continue
        path = lake.path("gold", table)
        if silver is not None and not set(needed) <= set(silver.columns):
            reports.append(TableReport(table, None, fixed.SKIPPED_COLUMNS, 0))
            continue
        reports.append(
            guarded(table, path, lambda p=path, t=table, b=build: publish(t, p, None if silver is None else b(silver)))
        )
    return reports


def run_gold(
    spark: SparkSession, lake: Lake, source: str, only: Collection[str] | None = None, target: Lake | None = None
) -> list[TableReport]:
    """Gold tables from one silver table: products (B5), reviews (B6), categories (B7) or sellers.

    ``only`` names the outputs to build; they go to ``target``, the same lake
    unless told otherwise.
    """
    known = {from_ for from_, _, _ in OUTPUTS.values()}
    if source not in known:
        raise ValueError(f"unknown silver table {source!r}, expected one of {sorted(known)}")
    unknown = set(only or ()) - {table for table, (from_, _, _) in OUTPUTS.items() if from_ == source}
    if unknown:
        raise ValueError(f"{source!r} has no outputs {sorted(unknown)}")
    return build_outputs(read_required(spark, lake.path("silver", source)), source, target or lake, only)
