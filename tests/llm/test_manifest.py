"""The manifest against a plain Python tree, and its parts."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakemart.llm import manifest
from tests.llm import edge


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row[:5]
    fields = (doc_id, source, lang, None if n_chars is None else n_chars + more, text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels(nodes):
    every = [nodes]
    while len(every[-1]) > 1:
        every.append([h(*every[-1][i : i + 2]) for i in range(0, len(every[-1]), 2)])
    return every


def siblings(every, place):
    """Per level the side of the sibling and its digest, or None."""
    out = []
    for nodes in every[:-1]:
        other = place ^ 1
        out.append((other < place, nodes[other]) if other < len(nodes) else None)
        place >>= 1
    return out


def plain_report(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is None, r[0] or 0, plain_leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([m[2] for m in sorted(groups[g], key=lambda m: m[:3])]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for i, g in enumerate(order):
        for place, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda m: m[:3])):
            path = siblings(trees[g], place) + siblings(top, i)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = plain_leaf(r, 1 if tampered else 0)
            for step in path:
                node = h(node) if step is None else h(step[1], node) if step[0] else h(node, step[1])
            proof = h(*(s[1] for s in path if s))
            out.append((r[0], leaf, trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, edge.SCHEMA)


def with_langs(rows, langs):
    return [(*r[:2], langs[i % len(langs)], *r[3:]) for i, r in enumerate(rows)]


CASES = {
    "edge rows": with_langs(edge.documents(), ["en", None, "é", "z", "", "Z", "en"]),
    "one row": [edge.row(5, "only one")],
    "rows alike": with_langs([edge.row(None, "same")] * 700 + [edge.row(3, "x")] * 5 + [edge.row(3, "y")], ["en"]),
    "several arrays": with_langs([edge.row(i * i * 37 - 900, f"text {i}") for i in range(2600)], ["en"] * 30 + ["de", None]),
    "many groups": [(i, f"t {i}", f"lang {i % 1300}", "s", i, 7, "d", "n", "s", 3, "i", "k") for i in range(1500)],
}


@pytest.mark.parametrize("case", CASES)
def test_proofs_match_a_plain_tree(spark, case):
    rows = CASES[case]
    got = manifest.proof_report(frame(spark, rows).repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(plain_report(rows))


def test_empty_table(spark):
    empty = manifest.proof_report(frame(spark, edge.documents()).filter("false"))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"
    assert manifest.build(frame(spark, edge.documents()).filter("false")).root is None


def test_places_are_ranks(spark):
    """Places by bitmap equal a sort, for ids of both signs, dense and sparse."""
    ids = [*range(-200, 200, 3), 2**62, 2**62 + 1, -(2**63), 2**63 - 1, *range(10**12, 10**12 + 70)]
    leaves = spark.createDataFrame([("1a" if i % 5 else "0", i) for i in ids], "grp string, doc_id long")
    leaves = leaves.withColumns({"word": F.shiftright("doc_id", 6), "leaf": F.sha2(F.col("doc_id").cast("string"), 256), "row_no": F.monotonically_increasing_id()})
    got = {(r["grp"], r["doc_id"]): r["place"] for r in manifest.with_places(leaves.repartition(3)).collect()}
    for grp in ("1a", "0"):
        mine = sorted(i for i in ids if ("1a" if i % 5 else "0") == grp)
        assert [got[grp, i] for i in mine] == list(range(len(mine)))


def test_rows_with_one_id_are_ranked_in_several_tasks(spark):
    rows = spark.range(4000).select(F.lit("g").alias("grp"), F.lit(1).cast("long").alias("one"), F.col("id").alias("row_no"))
    ranked = manifest.running_total(rows.repartition(5), ["grp", "row_no"], "one")
    assert ranked.filter("before <> row_no").count() == 0
    tasks = rows.repartitionByRange(4, "grp", "row_no").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 4 and max(t["count"] for t in tasks) < 2000


def test_words_of_absent_ids_are_not_stored(spark):
    leaves = spark.range(0, 6400, 640).select(F.lit("g").alias("grp"), F.col("id").alias("doc_id"), F.shiftright("id", 6).alias("word"))
    words = manifest._words(leaves).orderBy("word").collect()
    assert len(words) == 10 and [w["base"] for w in words] == list(range(10))
