"""DataFrame -> DataFrame operators."""

from lakemart.operators.checks import check_declared_keys, foreign_key_violations, primary_key_violations
from lakemart.operators.dedup import distinct_keys, keep_one
from lakemart.operators.filters import all_true, has_id, present
from lakemart.operators.flatten import flatten_listing, flatten_products, flatten_reviews, flatten_sellers
from lakemart.operators.keys import keep_known, keep_new
from lakemart.operators.project import select_existing, union_all

__all__ = [
    "all_true",
    "check_declared_keys",
    "distinct_keys",
    "flatten_listing",
    "flatten_products",
    "flatten_reviews",
    "flatten_sellers",
    "foreign_key_violations",
    "has_id",
    "keep_known",
    "keep_new",
    "keep_one",
    "present",
    "primary_key_violations",
    "select_existing",
    "union_all",
]
