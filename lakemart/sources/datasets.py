"""Document datasets: schema, file names and flattening of each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lakemart import fixed, schemas
from lakemart.operators.flatten import flatten_products, flatten_reviews, flatten_sellers


@dataclass(frozen=True)
class Dataset:
    name: str
    schema: str
    files: str
    #: Document without values that flattens to one row.
    blank: str
    flatten: Callable[..., DataFrame]


DATASETS = {
    d.name: d
    for d in (
        Dataset("products", schemas.scalars_as_text(schemas.PRODUCT_DOCUMENT), fixed.PRODUCT_FILES, "{}", flatten_products),
        Dataset("sellers", schemas.scalars_as_text(schemas.SELLER_DOCUMENT), fixed.SELLER_FILES, '{"data": {"seller": {"id": ""}}}', flatten_sellers),
        Dataset("reviews", schemas.scalars_as_text(schemas.REVIEW_PAGE), fixed.REVIEW_FILES, '{"data": [{}]}', flatten_reviews),
    )
}


def dataset(name: str) -> Dataset:
    """Dataset by name; an unknown name is an error that lists the valid ones."""
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name!r}, expected one of {sorted(DATASETS)}")
    return DATASETS[name]
