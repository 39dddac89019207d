"""Bronze to silver."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemart import fixed, schemas
from lakemart.functions import (
    default_if_missing,
    epoch_to_timestamp,
    int_or_zero,
    label_or_default,
    membership_days,
    return_policy_label,
    warranty_days,
)
from lakemart.operators.dedup import keep_latest
from lakemart.operators.filters import has_id, present
from lakemart.operators.flatten import product_seller
from lakemart.operators.keys import few_keys, keep_known, keep_known_by_few, keep_known_in_parts
from lakemart.operators.places import SCRATCH, with_place, with_writer
from lakemart.plans import bronze
from lakemart.plans.report import TableReport, publish, unless_empty
from lakemart.scratch import freed_shuffles, scratch_path
from lakemart.sources.datasets import dataset
from lakemart.sources.paths import Lake, path_exists
from lakemart.sources.readers import (
    CRAWL_TIME,
    PROVENANCE,
    REFUSED,
    SOURCE_PATH,
    carry_rejects,
    read_compacted,
    read_csv,
    read_documents,
    read_upstream,
    with_refused,
)
from lakemart.sources.session import compiled_methods
from lakemart.sources.writers import write_parquet


def _latest(rows: DataFrame, keys: list[str], **steps) -> DataFrame:
    """The row of the newest crawl per key, without its provenance; rows without provenance go by their content."""
    newest, path = (name if name in rows.columns else None for name in (CRAWL_TIME, SOURCE_PATH))
    return keep_latest(rows, keys, newest, path, **steps).drop(*PROVENANCE)


def silver_sellers(sellers: DataFrame) -> DataFrame:
    """One row per real seller, counters filled; the filter is on the dedup key, so it runs first (B1)."""
    return _latest(sellers.filter(has_id("seller_id")), ["seller_id"]).transform(
        default_if_missing({"review_count": 0, "total_follower": 0, "days_since_joined": 0, "avg_rating_point": 0.0})
    )


def clean_products(offers: DataFrame, zero_rule: str = "any") -> DataFrame:
    """Defaults, labels and warranty days of product offers."""
    return offers.withColumns(
        {
            "brand_id": int_or_zero(F.col("brand_id"), "bigint"),
            "brand_name": label_or_default(F.col("brand_name"), fixed.NO_BRAND),
            "warranty_period_days": warranty_days(F.col("warranty_period"), zero_rule),
            "warranty_type": label_or_default(F.col("warranty_type"), fixed.NO_WARRANTY),
            "warranty_location": label_or_default(F.col("warranty_location"), fixed.NO_WARRANTY),
            "return_policy": return_policy_label(F.col("return_reason")),
            "quantity_sold": int_or_zero(F.col("quantity_sold")),
        }
    )


def silver_products(products: DataFrame, sellers: DataFrame, zero_rule: str = "any") -> DataFrame:
    """One row per product and seller, of known sellers only, cleaned.

    The seller is part of the key, so rows of unknown sellers go first where the
    sellers are few enough to be broadcast.  Else sellers are looked up for the
    chosen keys, before their rows are fetched.  Dedup then comes before that:
    the other way round Spark would reuse the join's partitioning by seller for
    the dedup, and a seller with many products would sit in one task.
    """
    if few_keys(sellers, ["seller_id"]):
        offers = keep_known_by_few(products, sellers, ["seller_id"])
        return clean_products(_latest(offers, ["product_id", "seller_id"]), zero_rule)
    known = partial(keep_known, parent=sellers, keys=["seller_id"], parent_unique=True)
    return clean_products(_latest(products, ["product_id", "seller_id"], after=known), zero_rule)


def silver_reviews(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Reviews of known offers, one per review id, with times and day counts.

    Join before dedup: a review id may occur under an unknown and a known
    product, and only the known one may survive.
    """
    offer = ["product_id", "seller_id"]
    if few_keys(products, offer):
        latest = _latest(keep_known_by_few(reviews, products, offer), ["review_id"])
    else:
        latest = _latest(reviews, ["review_id"], needed=offer, before=partial(keep_known_in_parts, parent=products, keys=offer))
    return latest.withColumns(
        {
            "created_ts": epoch_to_timestamp(F.col("created_at")),
            "purchased_ts": epoch_to_timestamp(F.col("purchased_at")),
            "joined_days": membership_days(F.col("joined_time")),
            "total_review": int_or_zero(F.col("total_review")),
            "total_thank": int_or_zero(F.col("total_thank")),
        }
    )


def _of_known_sellers(documents: DataFrame, sellers: DataFrame) -> DataFrame:
    """Product documents of known sellers, and those refused; the others need no flattening.

    The sellers are looked up by an outer join: it reads every document, whatever
    the sellers are, so that counts below it hold.  Sellers that are too many for
    a broadcast are looked up later, for chosen keys.
    """
    if not few_keys(sellers, ["seller_id"]):
        return documents
    known = sellers.select(F.col("seller_id").alias("_known")).filter(present("_known")).distinct()
    met = documents.join(F.broadcast(known), product_seller() == F.col("_known"), "left")
    return met.filter(F.col("_known").isNotNull() | F.col(REFUSED).isNotNull()).drop("_known")


def _run(
    spark: SparkSession,
    lake: Lake,
    name: str,
    layout: str,
    build: Callable[[DataFrame], DataFrame],
    wanted: Callable[[DataFrame], DataFrame] | None = None,
) -> TableReport:
    """One silver table from its documents; rejects go to ``<rejects layer>/<dataset>``.

    One pass parses the documents, stores their flat rows, and a row with the
    text of each reject, and counts both; nothing but the write stands above
    the counts, so they hold whatever the parents are.  The rest reads the
    stored columns it needs; no document is parsed a second time.  ``wanted``
    leaves out good documents before they are flattened, of a dataset whose
    documents are a row each.
    """
    if layout == "document":
        bronze.update_manifest(spark, lake)
        bronze.compact(spark, lake, name)
        source = lake.path(bronze.LAYER, name)
        documents = read_compacted(spark, source, name)
    else:
        source = f"{lake.bronze}/{name}"
        documents = read_documents(spark, lake.bronze, name, layout)
    if not path_exists(spark, source):
        return publish(name, lake.path("silver", name), None)
    with compiled_methods(spark), freed_shuffles(spark):
        return _from_documents(spark, lake, name, documents, build, wanted)


def _from_documents(
    spark: SparkSession,
    lake: Lake,
    name: str,
    documents: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    wanted: Callable[[DataFrame], DataFrame] | None,
) -> TableReport:
    seen = Observation()
    refused = F.col(REFUSED)
    # Whether a document is refused is found once: no predicate passes the observation.
    counts = F.count(F.lit(1)).alias("n_documents"), F.count_if(refused.isNotNull()).alias("n_rejects")
    counted = with_refused(documents).observe(seen, *counts)
    counted = counted if wanted is None else wanted(counted)
    flat = dataset(name).flatten(carry_rejects(counted, name), [*PROVENANCE, REFUSED])
    path = scratch_path(spark, f"flat-{name}")
    n_rows = write_parquet(with_writer(flat), path, **SCRATCH)
    n_rejects = seen.get["n_rejects"]
    n_rows = n_rows if wanted is None else seen.get["n_documents"]
    stored = with_place(spark.read.parquet(path))
    good = stored.filter(refused.isNull()).drop(REFUSED)
    report = publish(name, lake.path("silver", name), build(good) if n_rows > n_rejects else None)
    if not n_rejects:
        return report
    rejects = stored.filter(refused.isNotNull()).select(SOURCE_PATH, refused.alias("raw"))
    return replace(report, n_rejects=write_parquet(rejects, lake.path("rejects", name)))


def run_sellers(spark: SparkSession, lake: Lake, layout: str = "document") -> TableReport:
    return _run(spark, lake, "sellers", layout, silver_sellers)


def run_categories(spark: SparkSession, lake: Lake) -> TableReport:
    """Categories pass through unchanged (B2)."""
    source = f"{lake.bronze}/categories.csv"
    rows = None
    if path_exists(spark, source):
        rows = unless_empty(read_csv(spark, source, schemas.CATEGORIES_CSV, multi_line=True), lambda categories: categories)
    return publish("categories", lake.path("silver", "categories"), rows)


def run_products(
    spark: SparkSession, lake: Lake, layout: str = "document", sellers_path: str | None = None, zero_rule: str = "any"
) -> TableReport:
    sellers = read_upstream(spark, sellers_path, lake.path("silver", "sellers"))
    wanted = partial(_of_known_sellers, sellers=sellers)
    return _run(spark, lake, "products", layout, lambda raw: silver_products(raw, sellers, zero_rule), wanted)


def run_reviews(
    spark: SparkSession, lake: Lake, layout: str = "document", products_path: str | None = None
) -> TableReport:
    products = read_upstream(spark, products_path, lake.path("silver", "products"))
    return _run(spark, lake, "reviews", layout, lambda raw: silver_reviews(raw, products))
