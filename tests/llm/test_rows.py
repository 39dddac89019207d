"""Operators that decide about rows: quality rules, exact dedup, mixing, pseudonyms."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakemart.llm import exact_dedup, mixing, pii, quality_rules
from tests.llm import edge


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge.documents(), edge.SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def _key(r):
    return (r["doc_id"] is None, r["doc_id"] or 0, str(r.asDict()))


def test_ledger_matches_plain_python(docs):
    got = quality_rules.ledger(docs.select("*", F.col("text").alias("t"))).collect()
    want = Counter()
    for r in edge.documents():
        bits = sum(1 << quality_rules.RULES.index(rule) for rule in edge.failed_rules(r[1]))
        want[(r[0], *(edge.measures(r[1])[m] for m in quality_rules.MEASURES), bits)] += 1
    assert Counter((r["doc_id"], *(r[m] for m in quality_rules.MEASURES), r["failed_bits"]) for r in got) == want


def test_policy_keeps_rows_whole(docs, none):
    kept = quality_rules.keep_passing(docs)
    assert kept.columns == docs.columns
    want = [r for r in edge.documents() if not edge.failed_rules(r[1])]
    assert Counter(map(tuple, kept.collect())) == Counter(want)
    assert quality_rules.keep_passing(none).count() == 0


def test_ablation_counts(docs, none):
    got = {r["rule"]: (r["n_failed"], r["n_failed_alone"], r["n_rejected"]) for r in quality_rules.ablation(quality_rules.ledger(docs)).collect()}
    failed = [edge.failed_rules(r[1]) for r in edge.documents()]
    for rule in quality_rules.RULES:
        assert got[rule] == (sum(rule in f for f in failed), sum(f == [rule] for f in failed), sum(bool(f) for f in failed))
    assert quality_rules.ablation(quality_rules.ledger(none)).count() == 0


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_exact_dedup(docs, none, broadcast_bytes):
    got = exact_dedup.dedup_decisions(docs, broadcast_bytes=broadcast_bytes).collect()
    groups = defaultdict(list)
    for r in edge.documents():
        groups[r[1] or ""].append(r[0])
    assert len(got) == len(edge.documents())
    kept = Counter()
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        ids = groups[text]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        kept[text] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1}
    rows = exact_dedup.keep_one_copy(docs, broadcast_bytes=broadcast_bytes)
    assert rows.columns == docs.columns
    assert Counter((r["text"] or "") for r in rows.collect()) == Counter(groups.keys())
    assert exact_dedup.dedup_decisions(none).count() == exact_dedup.keep_one_copy(none).count() == 0


def test_a_filter_beyond_the_broadcast_is_met_in_ranges_and_shuffles_repeats_only(spark):
    """3,000 texts, 899 of them twice, one 602 times; the filter of 900 repeats takes two ranges of 4 KB."""
    number = F.when(F.col("id") < 3900, F.col("id") % 3000).otherwise(7)
    docs = spark.range(4500).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), number).alias("text"))
    content = F.col("text")
    found, n_words, broadcast = exact_dedup._filter_for(docs.select(F.sha2(content, 256).alias("digest")), "digest", 8, 0)
    assert not broadcast
    tight, n_tight, n_ranges = exact_dedup._repeats_in_ranges(docs, content, found, n_words, 0)
    assert n_ranges == 2 and n_tight == 900 * 16 // 64
    rows = docs.select(F.sha2("text", 256).alias("digest"), "text")
    tested = exact_dedup._tested_in_ranges(rows, tight, n_tight, n_ranges)
    assert tested.count() == 4500
    assert 2400 <= tested.filter("maybe").count() < 2600
    kept = exact_dedup.keep_one_copy(docs, broadcast_bytes=0)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and all("hashpartitioning(digest" in line for line in shuffled)
    want = docs.groupBy("text").agg(F.max("doc_id").alias("doc_id"))
    assert Counter(map(tuple, kept.select("doc_id", "text").collect())) == Counter((r["doc_id"], r["text"]) for r in want.collect())


def test_repeat_filter_lets_no_repeat_through(spark):
    digests = spark.range(3000).select(F.sha2((F.col("id") % 2900).cast("string"), 256).alias("d"))
    found = exact_dedup.repeat_filter(digests, "d", 400)
    tested = exact_dedup._suspects(digests, "d", found, 400, True)
    repeated = digests.groupBy("d").count().filter("count > 1").select("d")
    assert tested.filter("maybe").join(repeated, "d", "left_semi").count() == 200
    assert tested.filter("maybe").count() < 800


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 1025])
def test_permutation_is_one_to_one(spark, n):
    got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long")).alias("p")).collect()
    assert sorted(r["p"] for r in got) == list(range(n))
    assert n < 64 or [r["p"] for r in got] != list(range(n))


def test_targets_share_again():
    assert mixing.targets([100, 100, 0], [5, 2, 1], 210, 2) == pytest.approx([150, 60, 0])
    assert sum(mixing.targets([100, 100, 100], [5, 2, 1], 450, 2)) == pytest.approx(450)
    assert mixing.targets([10, 1000], [5, 2], 100, 2) == [20.0, 80.0]
    assert mixing.targets([], [], 0, 2) == []


def test_mix(docs, none):
    rows = [r.asDict() for r in mixing.mix_report(docs, block_words=16, shard_slots=64).collect()]
    again = [r.asDict() for r in mixing.mix_report(docs.repartition(3), block_words=16, shard_slots=64).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == Counter((r[0], r[3], len(edge.words(r[1]))) for r in edge.documents())
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()), 2)
    for source, amount in zip(order, want, strict=True):
        assert target[source] == pytest.approx(amount)
        assert abs(taken[source] - amount) <= 40
    assert mixing.mix_report(none).count() == mixing.mix_documents(none).count() == 0


def test_mixed_documents_hold_the_taken_words(docs):
    options = {"block_words": 16, "shard_slots": 64}
    mixed = mixing.mix_documents(docs, **options)
    assert mixed.columns == docs.columns
    out = [r.asDict() for r in mixed.collect()]
    report = mixing.mix_report(docs, **options).collect()
    assert sum(len(edge.words(r["text"])) for r in out) == sum(r["taken"] for r in report)
    by_id = defaultdict(list)
    for r in edge.documents():
        by_id[r[0]].append(r)
    for r in out:
        assert r["n_chars"] == len(r["text"])
        assert any(" ".join(edge.words(r["text"])) in " ".join(edge.words(d[1])) and r["source"] == d[3] for d in by_id[r["doc_id"]])
    shards = mixing.shard_table(docs, **options).collect()
    slots = Counter()
    for r in shards:
        slots[r["shard"], r["slot"]] += r["n_words"]
    assert max(slots.values()) <= 16
    full = [s for s, _ in slots]
    assert max(Counter(full).values()) <= 64 * 16


PRIVATE = [
    (1, "mail hgl.25@mail2.example.com and +1 (668) 555-2190 4746854058905903 54.145.183.62 end"),
    (2, None),
    (3, ""),
    (4, "card 4746-8540-5890-5903 bad 4746854058905904 ip 300.1.1.1 ssn 123-45-6789 date 2024-02-29 31/12/1999 2024-02-30 01.02.2003"),
    (5, "Very.Long.Name.With.Letters123456789012345678901@x.org, hgl.25@mail2.example.com +1 (668) 555-2190 54.145.183.62"),
    (None, "\n54.145.183.62"),
    (7, "2100-01-01 version 1.2.3 room 12 at 10:30"),
]


def test_pseudonyms(spark):
    rows = spark.createDataFrame([(*r, 1, "x") for r in PRIVATE], "doc_id long, text string, finds int, row string")
    got = pii.pseudonymise(rows, "k")
    out = {r["doc_id"]: r for r in got.collect()}
    assert out[2]["text"] is None and out[3]["text"] == "" and out[7]["text"] == PRIVATE[6][1]
    assert got.columns[:4] == rows.columns and out[1]["finds"] == 1
    assert [out[1][f"n_{k}"] for k in pii.KINDS] == [1, 1, 0, 0, 1, 0, 1]
    assert [out[4][f"n_{k}"] for k in pii.KINDS] == [0, 0, 3, 1, 1, 0, 0]
    for word in ("hgl.25", "668", "4746854058905903", "54.145.183.62", "4746-8540", "123-45-6789", "2024-02-29", "31/12/1999", "01.02.2003", "Long.Name"):
        assert not any(word in (r["text"] or "") for r in out.values()), word
    for word in ("4746854058905904", "300.1.1.1", "2024-02-30", "@mail2.example.com", "@x.org", "+1 ("):
        assert any(word in (r["text"] or "") for r in out.values()), word
    card = re.search(r"\b\d{16}\b", out[1]["text"])[0]
    assert card[:4] + "-" + card[4:8] + "-" + card[8:12] + "-" + card[12:] in out[4]["text"]
    ip = re.search(r"\d+\.\d+\.\d+\.\d+", out[1]["text"])[0]
    assert out[5]["text"].endswith(ip) and out[None]["text"] == "\n" + ip and all(int(o) < 256 for o in ip.split("."))
    mail = re.search(r"\S+@mail2\.example\.com", out[1]["text"])[0]
    assert mail in out[5]["text"] and re.fullmatch(r"[a-z]{3}\.\d\d@mail2\.example\.com", mail)
    back = {r["doc_id"]: r["text"] for r in pii.restore(got.select("doc_id", "text"), "k").collect()}
    assert back == dict(PRIVATE)
    assert pii.pseudonymise(rows.filter("false"), "k").count() == 0


#: Finds of every format, by kind, and what only looks like one.
FORMS = {
    "date": ["2024-01-15", "31/12/1999", "01.02.1950"],
    "phone": ["+14155550123", "+44 20 7946 0958", "+1 (668) 555-2190", "(668) 555-2190", "+49-30-1234567", "+358 401234567"],
    "ssn": ["123 45 6789", "123-45-6789"],
    "ip": ["54.145.183.62", "2001:db8::1", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1ff:fe23:4567:890a", "2001:DB8::A"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "FR1420041010050500013M02606"],
    "email": ["jörg@x.de", "ÉLODIE.b7@mail.example.com", "a@b.c"],
    "card": ["4746 8540 5890 5903"],
}
NONE = ["DE89370400440532013001", "30/02/2024", "13/13/2000", "12:30:45", "a::b", "f(x)", "123 45 0000", "1.2.3", "std::vector", "10:30"]


def test_every_form_is_found_and_comes_back(spark):
    finds = [(kind, find) for kind, forms in FORMS.items() for find in forms]
    rows = spark.createDataFrame([(i, f"see {find}, or {find}; end", kind) for i, (kind, find) in enumerate(finds)], "i int, text string, kind string")
    got = pii.pseudonymise(rows, "k")
    for r in got.collect():
        kind, find = finds[r["i"]]
        assert r[f"n_{kind}"] == 2 == sum(r[f"n_{k}"] for k in pii.KINDS), r
        first, second = re.fullmatch(r"see (.*), or (.*); end", r["text"]).groups()
        # Single letters, and hex digits that stand alone, may stay the same by chance.
        assert first == second and (first != find or len(find) < 12), r
        # Octets have no leading zeros, so they may become longer or shorter; all else keeps its shape.
        shape = r"\d+" if kind == "ip" and "." in find else r"\w"
        assert re.sub(shape, "x", first) == re.sub(shape, "x", find)
    assert {r["i"]: r["text"] for r in pii.restore(got.select("i", "text"), "k").collect()} == {r["i"]: r["text"] for r in rows.collect()}
    other = spark.createDataFrame([(find,) for find in NONE], "text string")
    assert {r["text"] for r in pii.pseudonymise(other, "k").collect()} == set(NONE)


def test_a_time_may_follow_a_date(spark):
    rows = spark.createDataFrame([("at 2024-01-15T10:00:00 or 2024-01-15",)], "text string")
    (r,) = pii.pseudonymise(rows, "k").collect()
    first, second = re.fullmatch(r"at (\S+)T10:00:00 or (\S+)", r["text"]).groups()
    assert first == second != "2024-01-15" and r["n_date"] == 2


def test_long_texts_repeated_rows_and_clashing_names(spark):
    long = "no numbers here " * 20_000 + "54.145.183.62 " + "plain words " * 20_000
    rows = spark.createDataFrame([(1, long)] * 3 + [(1, "+14155550123")] * 2, "doc_id long, text string")
    got = pii.pseudonymise(rows, "k").collect()
    assert sorted(r["n_ip"] + r["n_phone"] for r in got) == [1] * 5 and len({r["text"] for r in got}) == 2
    assert all(len(r["text"]) >= len(long) - 15 for r in got if r["n_ip"])
    with pytest.raises(ValueError, match="n_card"):
        pii.pseudonymise(rows.withColumn("n_card", F.lit(1)), "k")


def test_the_key_is_in_no_plan(spark):
    rows = spark.createDataFrame([("54.145.183.62",)], "text string")
    plan = pii.pseudonymise(rows, "a very secret key")._jdf.queryExecution().toString()
    assert "very secret" not in plan


def test_pseudonyms_are_one_to_one(spark):
    days = spark.range(72900).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    assert pii.pseudonymise(days, "k").select("text").distinct().count() == 72900
    names = spark.range(676).select(F.concat(F.char(97 + F.col("id") % 26), F.char((97 + F.floor(F.col("id") / 26)).cast("long")), F.lit("@a.org")).alias("text"))
    got = pii.pseudonymise(names, "k").filter("n_email = 1")
    assert got.select("text").distinct().count() == 676


def test_social_security_numbers_of_all_areas(spark):
    areas = spark.range(1000).select("id", F.concat(F.lpad(F.col("id").cast("string"), 3, "0"), F.lit("-45-6789")).alias("text"))
    got = pii.pseudonymise(areas, "k")
    out = {r["id"]: r for r in got.collect()}
    valid = {a for a in range(1, 900) if a != 666}
    assert {a for a, r in out.items() if r["n_ssn"]} == valid
    for a in (665, 666, 667, 772, 899, 900):
        assert (out[a]["text"] == f"{a}-45-6789") == (a in (666, 900)), a
    assert {int(out[a]["text"][:3]) for a in valid} <= valid and len({out[a]["text"] for a in valid}) == 898
    assert any(int(out[a]["text"][:3]) > 666 for a in valid)
    back = pii.restore(got.select("id", "text"), "k").collect()
    assert {r["id"]: r["text"] for r in back} == {r["id"]: r["text"] for r in areas.collect()}
