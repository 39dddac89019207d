"""Object paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    """Text after the last slash; '' for a directory marker."""
    return F.substring_index(path, "/", -1)


def strip_prefix(path: Column, prefix: str) -> Column:
    """Path without a leading ``prefix``, unchanged when it starts otherwise."""
    return F.when(F.startswith(path, F.lit(prefix)), F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)


def path_level(path: Column, level: int) -> Column:
    """1-based path segment, NULL when the path is shorter."""
    return F.try_element_at(F.split(path, "/"), F.lit(level))


def document_path(kind: str, slug: Column, product_id: Column, seller_id: Column, page: Column | None = None) -> Column:
    """Bronze path of a product, seller or reviews document."""
    if kind == "reviews":
        if page is None:
            raise ValueError("a reviews path needs a page number")
        return F.format_string("%s/%d_%d/reviews/reviews_%d_%d_%d.json", slug, product_id, seller_id, product_id, seller_id, page)
    if kind not in ("product", "seller"):
        raise ValueError(f"kind must be product, seller or reviews, not {kind!r}")
    return F.format_string(f"%s/%d_%d/{kind}_%d_%d.json", slug, product_id, seller_id, product_id, seller_id)
