"""Format-preserving pseudonyms for personal data.

Numbers, dates and addresses are found by pattern, validated (Luhn digit of
cards, octets of IPv4, ranges of dates and social security numbers), and
permuted inside their own format by a keyed Feistel network.  A permutation is
one to one and depends on the key alone, so equal values get equal pseudonyms
in every document, different ones stay different, and with the key
:func:`restore` leads back.

Only functions of Spark run, one row at a time: no shuffle, no table of
pseudonyms, nothing that grows.

| kind | format | what is permuted |
| --- | --- | --- |
| card | 13 to 19 digits, plain or in groups, Luhn digit right | all digits but the last, which is computed anew |
| phone | ten digits in groups, country code in front or not; or ``+`` and 8 to 15 digits, however grouped | the digits after the country code |
| ssn | ddd-dd-dddd, or with spaces, of areas 001-665 and 667-899, group and serial above 0 | the three numbers inside their ranges |
| ip | four octets up to 255; IPv6 with eight groups or ``::`` | the 32 bits; the hex digits of each group |
| iban | country, two check digits right modulo 97, 11 to 30 characters, plain or in fours | the digits after the check digits, which are computed anew |
| date | yyyy-mm-dd, dd/mm/yyyy, dd.mm.yyyy from 1900-01-01; a time may follow | the day, inside 270 * 270 days |
| email | name@host | letters of the Latin alphabets and digits of the name; case and other characters stay |

The key itself is in no plan: the driver derives a key per round and only those
stand in plans, ``explain`` and event logs.  They are enough to undo the
pseudonyms, so logs of these jobs are as secret as the key is.

Defined results: a null text stays null with counts of 0, an empty one empty.
What looks like a kind but is not valid stays as it is.  Dates beyond the range
(from 2099-08-05 on) stay.  Ids are not looked at; repeated rows are rows like
others.  Extra columns are kept, whatever their names, unless they are called
like the counts, which is an error.
"""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import packed

ROUNDS = 8
_KEY_CHARS = 32
_NAME = r"[\p{L}\p{M}0-9._%+\-]"
EMAIL = rf"(?<!{_NAME}){_NAME}++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"
PHONE = r"(?<![\w+])(?:(?:\+\d{1,3}[ .\-]?)?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}|\+\d(?:[ .\-]?\(?\d\)?){7,14})(?!\w)"
#: Country codes: two of one digit, those of two, all others of three.
_COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?!\w)"
_HEX = r"[0-9A-Fa-f]{1,4}"
IP6 = rf"(?<![\w:.])(?:(?:{_HEX}:){{7}}{_HEX}|{_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?|::{_HEX}(?::{_HEX}){{1,6}})(?![\w:.])"
IP4 = r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)"
SSN = r"(?<![\w\-])(?:\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4})(?![\w\-])"
DATE = r"(?<![\w/\-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?:(?=T\d)|(?![\w/\-]))"
CARD = r"(?<!\w)(?:\d{13,19}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?!\w)"
#: Leftmost first, in this order where two start at one place.
KINDS = {"email": EMAIL, "ip": f"(?:{IP4})|(?:{IP6})", "date": DATE, "ssn": SSN, "card": CARD, "iban": IBAN, "phone": PHONE}
_ANY = "|".join(f"(?:{p})" for p in KINDS.values())
_FIRST_DAY, _SIDE = "1900-01-01", 270
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_ACCENTED = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ"


def round_keys(key: str) -> str:
    """What plans hold of a key: a digest per round, joined; derived on the driver."""
    return "".join(hmac.new(key.encode(), f"round {turn}".encode(), hashlib.sha256).hexdigest()[:_KEY_CHARS] for turn in range(ROUNDS))


def _noise(key: str, tweak: Column, turn: Column, other: Column, bound: Column) -> Column:
    """A keyed number below ``bound``; ``key`` are the round keys."""
    mine = F.substring(F.lit(key), turn * _KEY_CHARS + 1, F.lit(_KEY_CHARS))
    digest = F.sha2(F.concat_ws("|", mine, tweak, turn.cast("string"), other.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), bound)


def feistel(value: Column, left: Column, right: Column, key: str, tweak: Column, back: bool = False) -> Column:
    """Permutes ``0 .. left * right - 1``: halves below ``left`` and ``right`` take turns in shifting each other."""
    turns = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    sign = -1 if back else 1

    def step(at: Column, turn: Column) -> Column:
        a, b = at["a"], at["b"]
        even = turn % 2 == 0
        shift = _noise(key, tweak, turn, F.when(even, b).otherwise(a), F.when(even, left).otherwise(right)) * sign
        return F.struct(
            F.when(even, F.pmod(a + shift, left)).otherwise(a).alias("a"),
            F.when(even, b).otherwise(F.pmod(b + shift, right)).alias("b"),
        )

    start = F.struct(F.call_function("div", value, right).alias("a"), F.pmod(value, right).alias("b"))
    return F.aggregate(F.array(*[F.lit(t) for t in turns]), start, step, lambda at: at["a"] * right + at["b"])


def _power(radix: int, exponent: Column) -> Column:
    powers = F.array(*[F.lit(radix**i).cast("long") for i in range(19 if radix == 10 else 13)])
    return F.get(powers, exponent)


def _digits_permuted(digits: Column, key: str, tweak: str, back: bool) -> Column:
    """Digits of one to 18 places, zeros in front included."""
    n = F.length(digits)
    right = (n / 2).cast("int")
    value = feistel(digits.cast("long"), _power(10, n - right), _power(10, right), key, F.concat(F.lit(f"{tweak}:"), n.cast("string")), back)
    return F.lpad(value.cast("string"), n, "0")


def _letters_permuted(letters: Column, key: str, tweak: str, back: bool, alphabet: str = _LETTERS) -> Column:
    """Letters of one to 12 places, as numbers of the base of their alphabet."""
    n, base = F.length(letters), len(alphabet)
    value = F.aggregate(
        F.split(letters, ""), F.lit(0).cast("long"), lambda v, c: v * base + F.when(c == "", F.lit(0)).otherwise(F.instr(F.lit(alphabet), c) - 1)
    )
    right = (n / 2).cast("int")
    out = feistel(value, _power(base, n - right), _power(base, right), key, F.concat(F.lit(f"{tweak}:"), n.cast("string")), back)
    places = F.sequence(n - 1, F.lit(0), F.lit(-1))
    return F.array_join(F.transform(places, lambda p: F.substring(F.lit(alphabet), (F.pmod(F.call_function("div", out, _power(base, p)), F.lit(base)) + 1).cast("int"), F.lit(1))), "")


def _in_parts(text: Column, size: int, permute: Callable[[Column], Column]) -> Column:
    """Each part of ``size`` characters permuted; the empty text stays."""
    starts = F.sequence(F.lit(0), F.call_function("div", F.length(text) - 1, F.lit(size)).cast("int"))
    parts = F.transform(starts, lambda i: permute(F.substring(text, i * size + 1, F.lit(size))))
    return F.when(F.length(text) == 0, text).otherwise(F.array_join(parts, ""))


def _refilled(original: Column, kind: str, new: Column) -> Column:
    """``original`` with its characters of a class replaced, in order, by those of ``new``; letters keep their case."""
    state = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, c: Column) -> Column:
        mine = c.rlike(kind)
        fresh = F.substring(new, s["at"], F.lit(1))
        fresh = F.when(c.rlike(r"\p{Lu}"), F.upper(fresh)).otherwise(fresh)
        return F.struct(F.concat(s["out"], F.when(mine, fresh).otherwise(c)).alias("out"), F.when(mine, s["at"] + 1).otherwise(s["at"]).alias("at"))

    return F.aggregate(F.split(original, ""), state, step, lambda s: s["out"])


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of digits from the right, every second one doubled, starting with place ``doubled``."""
    values = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))

    def worth(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(i % 2 == doubled, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(c.cast("int"))

    return F.aggregate(F.transform(values, worth), F.lit(0), lambda a, b: a + b)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _card(found: Column, key: str, back: bool) -> Column:
    digits = _digits(found)
    body = _digits_permuted(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card", back)
    check = F.pmod(-_luhn_sum(body, 0), F.lit(10))
    return F.when(F.pmod(_luhn_sum(digits, 1), F.lit(10)) == 0, _refilled(found, "[0-9]", F.concat(body, check.cast("string"))))


def _phone(found: Column, key: str, back: bool) -> Column:
    digits = _digits(found)
    grouped = F.regexp_replace(found, r"^\+\d{1,3}[ .\-]?(?=[(\d])", "").rlike(r"^(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}$")
    code = F.when(grouped, F.substring(digits, F.lit(1), F.length(digits) - 10)).otherwise(F.regexp_extract(digits, _COUNTRY, 0))
    rest = F.substring(digits, F.length(code) + 1, F.length(digits))
    return _refilled(found, "[0-9]", F.concat(code, _digits_permuted(rest, key, "phone", back)))


def _ip(found: Column, key: str, back: bool) -> Column:
    return F.when(found.contains(":"), _ip6(found, key, back)).otherwise(_ip4(found, key, back))


def _ip6(found: Column, key: str, back: bool) -> Column:
    """Hex digits in order, in parts, whatever the groups; capitals stay capitals by place."""
    hexes = F.lower(F.regexp_replace(found, "[^0-9A-Fa-f]", ""))
    new = _in_parts(hexes, 12, lambda p: _letters_permuted(p, key, "ip6", back, "0123456789abcdef"))
    filled = _refilled(F.lower(found), "[0-9a-f]", new)
    return F.when(found.rlike("[A-F]") & ~found.rlike("[a-f]"), F.upper(filled)).otherwise(filled)


def _ip4(found: Column, key: str, back: bool) -> Column:
    octets = F.transform(F.split(found, r"\."), lambda o: o.cast("long"))
    value = F.aggregate(octets, F.lit(0).cast("long"), lambda v, o: v * 256 + o)
    side = F.lit(1 << 16).cast("long")
    new = feistel(value, side, side, key, F.lit("ip"), back)
    text = F.concat_ws(".", *[F.shiftright(new, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)])
    return F.when(F.forall(octets, lambda o: o <= 255) & (value >= 0), text)


def _date(found: Column, key: str, back: bool) -> Column:
    parts = F.split(found, r"[/.\-]")
    iso = F.substring(found, 5, 1) == "-"
    year, month, day = F.when(iso, parts[0]).otherwise(parts[2]), parts[1], F.when(iso, parts[2]).otherwise(parts[0])
    number = F.datediff(F.to_date(F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("yyyy-MM-dd"))), F.lit(_FIRST_DAY).cast("date")).cast("long")
    side = F.lit(_SIDE).cast("long")
    new = F.date_add(F.lit(_FIRST_DAY).cast("date"), feistel(number, side, side, key, F.lit("date"), back).cast("int"))
    mark = F.substring(found, 3, 1)
    text = F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(
        F.concat_ws("", F.date_format(new, "dd"), mark, F.date_format(new, "MM"), mark, F.date_format(new, "yyyy"))
    )
    return F.when((number >= 0) & (number < _SIDE * _SIDE), text)


def _modulo_97(text: Column) -> Column:
    """Remainder of digits and letters read as an IBAN reads them, A being 10."""
    characters = F.filter(F.split(text, ""), lambda c: c != "")

    def step(rest: Column, c: Column) -> Column:
        value = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return F.pmod(F.when(value > 9, rest * 100 + value).otherwise(rest * 10 + value), F.lit(97)).cast("int")

    return F.aggregate(characters, F.lit(0), step)


def _iban(found: Column, key: str, back: bool) -> Column:
    plain = F.replace(found, F.lit(" "), F.lit(""))
    country, body = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    digits = _in_parts(F.regexp_replace(body, "[^0-9]", ""), 18, lambda p: _digits_permuted(p, key, "iban", back))
    new = _refilled(body, "[0-9]", digits)
    check = F.lpad((F.lit(98) - _modulo_97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    valid = _modulo_97(F.concat(body, F.substring(plain, 1, 4))) == 1
    return F.when(valid, _refilled(found, "[0-9A-Z]", F.concat(country, check, new)))


def _ssn(found: Column, key: str, back: bool) -> Column:
    mark = F.substring(found, 4, 1)
    area, group, serial = (F.split(found, "[ -]")[i].cast("long") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group >= 1) & (serial >= 1)
    left, right = F.lit(898 * 99).cast("long"), F.lit(9999).cast("long")
    place = F.when(area > 666, area - 2).otherwise(area - 1)  # 666 is no area
    new = feistel((place * 99 + group - 1) * 9999 + serial - 1, left, right, key, F.lit("ssn"), back)
    high = F.call_function("div", new, right)
    place = F.call_function("div", high, F.lit(99))
    parts = (F.when(place >= 665, place + 2).otherwise(place + 1), F.pmod(high, F.lit(99)) + 1, F.pmod(new, right) + 1)
    first, second, third = (F.lpad(p.cast("string"), w, "0") for p, w in zip(parts, (3, 2, 4), strict=True))
    return F.when(valid, F.concat(first, mark, second, mark, third))


def _email(found: Column, key: str, back: bool) -> Column:
    name = F.substring_index(found, "@", 1)
    host = F.substring(found, F.length(name) + 1, F.length(found))
    letters = _in_parts(F.lower(F.regexp_replace(name, "[^A-Za-z]", "")), 12, lambda p: _letters_permuted(p, key, "email", back))
    digits = _in_parts(F.regexp_replace(name, "[^0-9]", ""), 18, lambda p: _digits_permuted(p, key, "email", back))
    accented = F.lower(F.regexp_replace(name, "[^À-ÖØ-Þà-öø-þ]", ""))
    others = _in_parts(accented, 12, lambda p: _letters_permuted(p, key, "email:accented", back, _ACCENTED))
    plain = _refilled(_refilled(name, "[A-Za-z]", letters), "[0-9]", digits)
    return F.concat(F.when(F.length(accented) > 0, _refilled(plain, "[À-ÖØ-Þà-öø-þ]", others)).otherwise(plain), host)


_PSEUDONYM = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "iban": _iban, "phone": _phone}


def _replacement(found: Column, key: str, back: bool) -> Column:
    """``kind, new`` of a find; ``new`` is null where it is not valid."""
    kind: Column | None = None
    new: Column | None = None
    for name, pattern in KINDS.items():
        mine = found.rlike(f"^(?:{pattern})$")
        kind = F.when(mine, F.lit(name)) if kind is None else kind.when(mine, F.lit(name))
        new = F.when(mine, _PSEUDONYM[name](found, key, back)) if new is None else new.when(mine, _PSEUDONYM[name](found, key, back))
    return F.struct(kind.alias("kind"), new.alias("new"))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``n_<kind>`` counts of what was replaced.

    ``back`` undoes it under the same key.  A column of the caller that is called
    like a count is an error, as it would be lost.
    """
    taken = {f"n_{kind}" for kind in KINDS} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are names of counts; rename them")
    key = round_keys(key)
    finds = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(_ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = packed(docs, F.col(f"`{text}`").alias("text")).withColumn("finds", finds)
    rows = rows.withColumn("news", F.transform("finds", lambda found: _replacement(found, key, back)))
    filled = F.zip_with("finds", "news", lambda found, new: F.coalesce(new["new"], found))
    gaps = F.split("text", _ANY, -1)
    joined = F.array_join(F.zip_with(gaps, filled, lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "")
    result = rows.withColumn("new_text", F.when(F.size("finds") > 0, joined).otherwise(F.col("text")))
    def replaced(kind: str) -> Column:
        return F.size(F.filter("news", lambda new: (new["kind"] == kind) & new["new"].isNotNull()))

    counts = [F.coalesce(replaced(kind), F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    kept = [F.col("new_text").alias(n) if n == text else F.col(f"row.`{n}`").alias(n) for n in docs.columns]
    return result.select(*kept, *counts)


def restore(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Undoes :func:`pseudonymise` under the same key."""
    return pseudonymise(docs, key, text, back=True)


def pseudonym_report(docs: DataFrame) -> DataFrame:
    """Ids, texts with pseudonyms, and counts; the key is for this query only."""
    return pseudonymise(docs.select("doc_id", "text"), "documents-1")
