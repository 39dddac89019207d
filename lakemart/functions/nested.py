"""Array-of-struct fields of a product document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart import fixed
from lakemart.functions.cleaning import whole_number

_AUTHORS = "array<struct<author_id: bigint, author_name: string>>"


def specification_text(groups: Column) -> Column:
    """``name: value`` per attribute of every group, one per line; '' when there are none."""

    def line(attribute: Column) -> Column:
        return F.concat(
            F.coalesce(attribute["name"], F.lit("")),
            F.lit(fixed.ATTRIBUTE_SEPARATOR),
            F.coalesce(attribute["value"], F.lit("")),
        )

    # flatten() is NULL as soon as one inner array is, hence the per-group default.
    lines = F.transform(
        groups, lambda g: F.coalesce(F.transform(g["attributes"], line), F.array().cast("array<string>"))
    )
    return F.coalesce(F.array_join(F.flatten(lines), fixed.LINE_SEPARATOR), F.lit(""))


def named_entries(entries: Column) -> Column:
    """(name, value) list with names lower-cased and underscored, for several lookups in one list."""
    return F.transform(
        entries,
        lambda e: F.struct(
            F.replace(F.lower(e["name"]), F.lit(" "), F.lit("_")).alias("name"), e["value"].alias("value")
        ),
    )


def last_value_of(entries: Column, key: str) -> Column:
    """Value of the last of the named entries called ``key``.

    A filter instead of a map: keys may repeat, and a map would raise.
    """
    return F.try_element_at(F.filter(entries, lambda e: e["name"] == key), F.lit(-1))["value"]


def breadcrumb_path(crumbs: Column) -> Column:
    """Names of all crumbs but the last; NULL for a missing or empty list (E5)."""
    names = F.slice(crumbs["name"], F.lit(1), F.greatest(F.size(crumbs) - 1, F.lit(0)))
    return F.when(F.size(crumbs) > 0, F.array_join(names, fixed.BREADCRUMB_SEPARATOR))


def category_of(crumbs: Column) -> Column:
    """Category number of the first crumb."""
    return F.try_element_at(crumbs, F.lit(1))["category_id"]


def image_urls(images: Column) -> Column:
    """Base URLs; a missing list gives an empty one."""
    return F.coalesce(images["base_url"], F.array().cast("array<string>"))


def author_list(authors: Column) -> Column:
    """(author_id, author_name) pairs; a missing list gives an empty one."""
    pairs = F.transform(authors, lambda a: F.struct(whole_number(a["id"]).alias("author_id"), a["name"].alias("author_name")))
    return F.coalesce(pairs, F.array().cast(_AUTHORS))
