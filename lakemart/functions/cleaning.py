"""Missing values, casts and labels (E10-E16, E22, E23).  Missing is SQL NULL throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart import fixed

#: Seconds of which the microseconds still fit a long.
_MOST_SECONDS = (2**63 - 1) // 1_000_000


_BLANK = r"[\x00-\x20\x7f]*+"
_INTEGER = rf"\A{_BLANK}[+-]?[0-9]++{_BLANK}\z"
_NUMBER = (
    rf"\A{_BLANK}[+-]?(?:(?:[0-9]++\.?[0-9]*+|\.[0-9]++)(?:[eE][+-]?[0-9]++)?[fFdD]?|0[xX].*+|(?i:nan|inf(?:inity)?)){_BLANK}\z"
)
#: Patterns that every text matches which has a value of the type; what else matches costs a failing cast.
_CASTABLE = {"int": _INTEGER, "bigint": _INTEGER, "double": _NUMBER}


def lenient_cast(value: Column, to: str) -> Column:
    """Cast that gives NULL where the value does not fit (E14); NaN does not fit an integer.

    Text that is no number is never cast to one: the cast would give NULL all
    the same, at the cost of an exception per value.
    """
    if to not in _CASTABLE:
        return value.try_cast(to)
    return F.when((F.typeof(value) != "string") | F.rlike(value.cast("string"), F.lit(_CASTABLE[to])), value.try_cast(to))


def whole_number(value: Column, to: str = "bigint") -> Column:
    """A number, or text of one, less its fraction; NULL for anything else.

    Text with a point is never cast to an integer, which spares it the pattern.
    """
    pointed = (F.typeof(value) == "string") & F.contains(value.cast("string"), F.lit("."))
    return F.coalesce(F.when(pointed, F.lit(None)).otherwise(lenient_cast(value, to)), lenient_cast(value, "double").try_cast(to))


def int_or_zero(value: Column, to: str = "int") -> Column:
    """NULL, NaN and unreadable numbers become 0."""
    return F.coalesce(value.try_cast(to), F.lit(0).cast(to))


def label_or_default(value: Column, default: str) -> Column:
    """NULL and empty text become ``default``."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def default_if_missing(columns: dict[str, object]):
    """``df.transform(default_if_missing({...}))``: NULL and NaN become the given value."""
    return lambda df: df.fillna({name: value for name, value in columns.items() if name in df.columns})


def return_policy_label(code: Column) -> Column:
    """Known return codes and NULL to their labels, other codes unchanged."""
    known = F.coalesce(code, F.lit("no_return"))
    label = known
    for name, text in fixed.RETURN_POLICY_LABELS.items():
        label = F.when(known == name, F.lit(text)).otherwise(label)
    return label


def epoch_to_timestamp(seconds: Column) -> Column:
    """Whole epoch seconds to a timestamp; NULL and NaN stay NULL, and so does what no timestamp holds."""
    whole = seconds.try_cast("bigint")
    return F.timestamp_seconds(F.when(whole.between(-_MOST_SECONDS, _MOST_SECONDS), whole))


def flag(value: Column) -> Column:
    """Boolean from text such as true, false, 1 or 0."""
    return value.try_cast("boolean")


def to_json_text(value: Column, keep_null_fields: bool = False) -> Column:
    """Struct, array or map to JSON text; NULL stays NULL."""
    return F.to_json(value, {"ignoreNullFields": "false" if keep_null_fields else "true"})


def parse_json(text: Column, schema: str) -> Column:
    """JSON text to a nested value, NULL fields where it does not parse."""
    return F.from_json(text, schema)


def nested_or(value: Column, default: object) -> Column:
    """Nested value or a default where any level is missing."""
    return F.coalesce(value, F.lit(default))
