"""Duration texts to days."""

from __future__ import annotations

import sys
import unicodedata
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart import fixed

# (?U) lets \s and \d follow Unicode, so a no-break space counts as white space;
# the four separator controls are white space in Unicode text processing but not for Java.
_SPACE = r"[\s\x1c-\x1f]"

# A number of at most ten significant digits, captured, or a longer one, not captured: eleven never fit an int,
# and ten times any unit fit a bigint.
_NUMBER = r"(?:(?<!\d)0*(\d{1,10})|\d+)"

# Digits of other scripts, as the pattern takes them, and their values.
_OTHER_DIGITS = [c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isdecimal()]
_DIGITS, _VALUES = "".join(_OTHER_DIGITS), "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)

# Every value below is used once: Spark evaluates a repeated expression inside CASE each time it
# occurs.  Casts run behind a test that lets them succeed: a failing one costs an exception per row.


def _days(digits: Column, days_per_unit: Column) -> Column:
    """Digits times unit as int; 0 when the number does not fit."""
    return F.coalesce((F.translate(digits, _DIGITS, _VALUES).try_cast("bigint") * days_per_unit).try_cast("int"), F.lit(0))


def _has(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(word)) for word in words])


def _has_unit(text: Column, words: tuple[str, ...]) -> Column:
    """A number right before one of the words; the plain word test spares most texts the pattern."""
    return _has(text, words) & F.rlike(text, F.lit(rf"(?U)\d{_SPACE}*(?:{'|'.join(words)})"))


def _unit_days(text: Column, words: tuple[str, ...], days_per_unit: int) -> Column:
    number = F.regexp_extract(text, rf"(?U){_NUMBER}{_SPACE}*(?:{'|'.join(words)})", 1)
    return _days(number, F.lit(days_per_unit))


def warranty_days(text: Column, zero_rule: str = "any") -> Column:
    """Warranty text to days; lifetime, then "none", then years, months, days.

    ``zero_rule="any"`` takes every ``0`` in the text for "no warranty", so
    "10 months" gives 0; ``"whole"`` does so only for a 0 that stands alone.
    """
    if zero_rule not in ("any", "whole"):
        raise ValueError(f"zero_rule must be 'any' or 'whole', not {zero_rule!r}")
    lowered = F.lower(text)
    zero = F.contains(lowered, F.lit("0")) if zero_rule == "any" else F.rlike(lowered, F.lit(r"(?<!\d)0(?!\d)"))
    # A blank or unknown text meets no branch, so it needs no trimming and no test of its own.
    return (
        F.when(F.contains(lowered, F.lit(fixed.LIFETIME_WARRANTY)), F.lit(fixed.LIFETIME_DAYS))
        .when(_has(lowered, fixed.NO_WARRANTY_WORDS) | zero, F.lit(0))
        .when(_has_unit(lowered, fixed.YEAR_WORDS), _unit_days(lowered, fixed.YEAR_WORDS, fixed.DAYS_PER_YEAR))
        .when(_has_unit(lowered, fixed.MONTH_WORDS), _unit_days(lowered, fixed.MONTH_WORDS, fixed.DAYS_PER_MONTH))
        .when(_has_unit(lowered, fixed.DAY_WORDS), _unit_days(lowered, fixed.DAY_WORDS, 1))
        .otherwise(F.lit(0))
    )


def membership_days(text: Column) -> Column:
    """First "<number> <unit>" in a membership-age text to days, case-sensitive."""
    units = "|".join(fixed.MEMBERSHIP_UNITS)
    pattern = rf"(?U){_NUMBER}{_SPACE}+({units})"
    days_per_unit = F.create_map(*[F.lit(x) for pair in fixed.MEMBERSHIP_UNITS.items() for x in pair])
    factor = F.try_element_at(days_per_unit, F.regexp_extract(text, pattern, 2))
    found = F.rlike(text, F.lit(rf"(?U)\d{_SPACE}+(?:{units})"))
    return F.when(found, _days(F.regexp_extract(text, pattern, 1), factor)).otherwise(F.lit(0))
