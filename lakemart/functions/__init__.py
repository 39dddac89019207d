"""Column -> Column functions: built-in Spark expressions only, no Python UDFs."""

from lakemart.functions.cleaning import (
    default_if_missing,
    epoch_to_timestamp,
    flag,
    int_or_zero,
    label_or_default,
    lenient_cast,
    nested_or,
    parse_json,
    return_policy_label,
    to_json_text,
    whole_number,
)
from lakemart.functions.durations import membership_days, warranty_days
from lakemart.functions.links import anchor_links, category_id_of, slug_of, titled
from lakemart.functions.nested import (
    author_list,
    breadcrumb_path,
    category_of,
    image_urls,
    last_value_of,
    named_entries,
    specification_text,
)
from lakemart.functions.paths import basename, document_path, path_level, strip_prefix

__all__ = [
    "anchor_links",
    "author_list",
    "basename",
    "breadcrumb_path",
    "category_id_of",
    "category_of",
    "default_if_missing",
    "document_path",
    "epoch_to_timestamp",
    "flag",
    "image_urls",
    "int_or_zero",
    "label_or_default",
    "last_value_of",
    "lenient_cast",
    "membership_days",
    "named_entries",
    "nested_or",
    "parse_json",
    "path_level",
    "return_policy_label",
    "slug_of",
    "specification_text",
    "strip_prefix",
    "titled",
    "to_json_text",
    "warranty_days",
    "whole_number",
]
