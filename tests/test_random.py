"""Random inputs against plain brute force."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from lakemart import functions as L
from lakemart.operators import foreign_key_violations, keep_known, keep_new, keep_one, primary_key_violations

TOKENS = [
    *("1", "2", "35", "0", "10", "007", "12345678901", "1999999999", "2147483647", "٣"),
    *("năm", "NĂM", "year", "tháng", "Tháng", "month", "ngày", "days"),
    *("không", "No warranty", "trọn đời", "bảo hành", "và"),
    *(" ", "  ", "\u00a0", "\t", "\n", "-"),
]


def random_texts(seed, n=3000):
    rng = random.Random(seed)
    weights = [6 if t in ("1", "2", "35") else 3 if t.strip() == "" else 1 for t in TOKENS]
    return ["".join(rng.choices(TOKENS, weights, k=rng.randint(0, 6))) for _ in range(n)]


def numbers_before_units(text, units, gap_needed):
    """(number, unit) for each run of digits with a unit behind it, left to right."""
    position = 0
    while position < len(text):
        if not text[position].isdigit():
            position += 1
            continue
        end = position
        while end < len(text) and text[end].isdigit():
            end += 1
        rest = text[end:].lstrip()
        if not gap_needed or len(rest) < len(text) - end:
            for unit in units:
                if rest.startswith(unit):
                    yield int(text[position:end]), unit
        position = end


def fitting(days):
    return days if days < 2**31 else 0


def warranty_by_hand(text, whole):
    text = text.lower()
    if "trọn đời" in text:
        return 36500
    runs = "".join(c if c.isdigit() else " " for c in text).split()
    if "không" in text or "no warranty" in text or ("0" in runs if whole else "0" in text):
        return 0
    for units, days in ((("năm", "year"), 365), (("tháng", "month"), 30), (("ngày", "day"), 1)):
        for number, _ in numbers_before_units(text, units, gap_needed=False):
            return fitting(number * days)
    return 0


def test_warranty_days(spark):
    texts = random_texts(1)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    result = df.select("i", L.warranty_days(F.col("t")), L.warranty_days(F.col("t"), "whole")).orderBy("i").collect()
    for (_, plain, whole), text in zip(result, texts, strict=True):
        assert (plain, whole) == (warranty_by_hand(text, False), warranty_by_hand(text, True)), repr(text)
    assert len({r[1] for r in result}) > 10


def test_membership_days(spark):
    texts = random_texts(2)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    result = df.select("i", L.membership_days(F.col("t"))).orderBy("i").collect()
    units = {"năm": 365, "tháng": 30, "ngày": 1}
    for (_, days), text in zip(result, texts, strict=True):
        first = next(numbers_before_units(text, units, gap_needed=True), None)
        assert days == (fitting(first[0] * units[first[1]]) if first else 0), repr(text)


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            written = dict(attrs)
            self.found.append(tuple("" if n in written and written[n] is None else written.get(n) for n in ("title", "href")))


def test_anchor_links(spark):
    rng = random.Random(3)
    pieces = [
        '<a href="/a/c1">',
        "<a title='T &amp; t' href=/b>",
        '<A HREF="x" Title="q > r">',
        "<a>",
        "<a\n title=z\n>",
        "<a title href='h'>",
        '<a data-title="no" hreflang="vi">',
        "<abbr title='no'>",
        "<!-- <a href='comment'> -->",
        "<script>var s = '<a href=\"no\">';</script>",
        "<div class='a'>",
        "</div>",
        "text ",
        "</a>",
        '<a href="one" href2="two"/>',
    ]
    pages = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, h string")
    for row, page in zip(df.select("i", L.anchor_links(F.col("h")).alias("l")).orderBy("i").collect(), pages, strict=True):
        parser = Anchors()
        parser.feed(page)
        assert [tuple(x) for x in row.l] == parser.found, page


def skewed_rows(seed, n=4000):
    """(k, s, v): one key pair holds a third of the rows, some keys are NULL."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        key = (1, 1) if rng.random() < 1 / 3 else (rng.choice([None, *range(40)]), rng.randint(0, 3))
        rows.append((*key, rng.choice([None, *range(500)])))
    return rows


def test_keyed_operators_on_a_heavy_key(spark):
    rows, others = skewed_rows(4), [r[:2] for r in skewed_rows(5) if r[2] is None or r[2] % 2]
    df = spark.createDataFrame(rows, "k int, s int, v int").repartition(7)
    known = spark.createDataFrame(others, "k int, s int").repartition(5)
    ordered = sorted(rows, key=lambda r: (r[2] is None, r[2] or 0))
    first = {}
    for row in ordered:
        first.setdefault(row[:2], row)

    def found(frame):
        return sorted((tuple(r) for r in frame.collect()), key=repr)

    assert found(keep_one(df, ["k", "s"])) == sorted(first.values(), key=repr)
    pairs = {o for o in others if None not in o}
    assert found(keep_known(df, known, ["k", "s"], False)) == sorted((r for r in rows if r[:2] in pairs), key=repr)
    assert found(keep_new(df, known, ["k", "s"], False)) == sorted((r for r in rows if r[:2] not in pairs), key=repr)
    counts = {}
    for row in rows:
        counts[row[:2]] = counts.get(row[:2], 0) + 1
    repeated = [(*k, n, "null" if None in k else "duplicate") for k, n in counts.items() if n > 1 or None in k]
    assert found(primary_key_violations(df, ["k", "s"])) == sorted(repeated, key=repr)
    orphans = [(*k, n) for k, n in counts.items() if None not in k and k not in pairs]
    assert found(foreign_key_violations(df, ["k", "s"], known.distinct())) == sorted(orphans, key=repr)
