"""Anchors of an HTML text.

One regular expression takes a page apart, token after token: what it has taken
is never looked at again, so each alternative stands for a state of a tokeniser.
A comment ends at ``-->``, an element of raw text at its own end tag, a quoted
value at its quote, all at the end of the page at the latest; markup inside
them is none.  Tokens are folded with higher-order functions, so a page never
leaves the JVM and pages spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart import fixed

# Possessive runs keep matching linear in the length of the page.
_ATTRIBUTE = r"""[^\s"'<>/=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+"""
_IN_TAG = rf"""(?:[\s/]++|{_ATTRIBUTE}|["'<=])*+>"""
_RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes"
_TOKEN = rf"(?is)<!--(?:-?>|.*?(?:-->|\z))|<({_RAW})(?=[\s/>]){_IN_TAG}.*?(?:</\1(?=[\s/>])[^>]*+>|\z)|</?[a-z][^\s/>]*+{_IN_TAG}"
_ANCHOR = r"(?i)^<a[\s/>]"
_ANCHOR_OR_DIV = r"(?i)^<(?:a|div)[\s/>]|^</div[\s>]"
_VALUE = r"""(?s)^[^=]*=\s*(?:"([^"]*)"|'([^']*)'|(.*))$"""
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#34;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


def _attribute(tag: Column, name: str) -> Column:
    """Attribute value with the basic entities decoded; NULL when the tag lacks it, the last one when repeated."""
    written = F.filter(
        F.regexp_extract_all(F.regexp_replace(tag, r"^<[^\s/>]+", ""), F.lit(_ATTRIBUTE), F.lit(0)),
        lambda token: F.rlike(token, F.lit(rf"(?is)^{name}(?:\s*=|$)")),
    )
    token = F.try_element_at(written, F.lit(-1))
    value = F.concat(*[F.regexp_extract(token, _VALUE, group) for group in (1, 2, 3)])
    for entity, character in _ENTITIES.items():
        value = F.replace(value, F.lit(entity), F.lit(character))
    return value


def _tags(html: Column, kind: str) -> Column:
    """Tags of a page that are markup and match ``kind``, in order."""
    return F.filter(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), lambda token: F.rlike(token, F.lit(kind)))


def _inside(html: Column, container_class: str) -> Column:
    """Anchor tags inside the first div with this class attribute, nested divs included.

    One fold finds where the div starts and stops in the list of tags; the
    list itself is cut afterwards, so the work stays linear in the page.
    """
    start = F.struct(*[F.lit(0).alias(name) for name in ("seen", "depth", "first", "last")])

    def step(state: Column, tag: Column) -> Column:
        lowered = F.lower(tag)
        closes = F.startswith(lowered, F.lit("</div"))
        opens = F.startswith(lowered, F.lit("<div"))
        inside = state["depth"] > 0
        starts = opens & (state["first"] == 0) & F.coalesce(_attribute(tag, "class") == container_class, F.lit(False))
        return F.struct(
            (state["seen"] + 1).alias("seen"),
            F.when(starts, F.lit(1))
            .when(inside & opens, state["depth"] + 1)
            .when(inside & closes, state["depth"] - 1)
            .otherwise(state["depth"])
            .alias("depth"),
            F.when(starts, state["seen"] + 2).otherwise(state["first"]).alias("first"),
            F.when(inside, state["seen"]).otherwise(state["last"]).alias("last"),
        )

    def bounds(state: Column) -> Column:
        # "last" is the tag before the closing one, or the last of all when the div is never closed.
        last = F.when(state["depth"] > 0, state["seen"]).otherwise(state["last"])
        return F.struct(state["first"].alias("first"), (last - state["first"] + 1).alias("length"))

    def cut(tags: Column) -> Column:
        def part(b: Column) -> Column:
            return F.when(b["first"] > 0, F.slice(tags, b["first"], F.greatest(b["length"], F.lit(0))))

        return F.element_at(F.transform(F.array(F.aggregate(tags, start, step, bounds)), part), 1)

    all_tags = _tags(html, _ANCHOR_OR_DIV)
    found = F.element_at(F.transform(F.array(all_tags), cut), 1)
    return F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda tag: F.startswith(F.lower(tag), F.lit("<a")))


def anchor_links(html: Column, container_class: str | None = None) -> Column:
    """Array of (title, href) over the anchors of a page, NULL where an attribute is absent."""
    tags = _tags(html, _ANCHOR) if container_class is None else _inside(html, container_class)
    return F.transform(tags, lambda t: F.struct(_attribute(t, "title").alias("title"), _attribute(t, "href").alias("href")))


def titled(links: Column) -> Column:
    """Only links that carry a title attribute (F8)."""
    return F.filter(links, lambda link: link["title"].isNotNull())


def slug_of(href: Column) -> Column:
    """Slug of a category link, NULL when the link is none."""
    return F.nullif(F.regexp_extract(href, fixed.CATEGORY_LINK, 1), F.lit(""))


def category_id_of(href: Column) -> Column:
    """Number of a category link, NULL when the link is none."""
    return F.nullif(F.regexp_extract(href, fixed.CATEGORY_LINK, 2), F.lit("")).try_cast("bigint")
