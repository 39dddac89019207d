"""Operators that compare texts: n-gram join, substring dedup, and their helpers."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakemart.llm import ngram_join, substring_dedup
from lakemart.llm.components import components
from lakemart.llm.words import Words, shingle_sets, small_batches, windows
from tests.llm import edge


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge.documents(), edge.SCHEMA)


def test_words_are_the_words():
    texts = ["", None, " a  b\n", "é ü\x0bz", "x" * 3_000_000 + " end", "tail", "\x1c\x85 \xa0"]
    w = Words(pa.array(["skip", *texts])[1:])
    data = w.data.tobytes()
    got = [[data[s:e].decode() for s, e in zip(w.starts[a:b], w.ends[a:b], strict=True)] for a, b in zip(w.first, w.first[1:], strict=False)]
    assert got == [edge.words(t) for t in texts]
    codes = w.codes()
    flat = [x for t in texts for x in edge.words(t)]
    assert len(set(codes.tolist())) == len(set(flat)) and Words(pa.array(["b"])).codes()[0] == codes[flat.index("b")]
    assert Words(pa.array(["ÀB c"]), lower=True).data.tobytes().decode() == "Àb c"
    assert len(Words(pa.array([], pa.string()))) == 0
    assert [b.num_rows for b in small_batches(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])]), "t", 5)] != []


def test_window_codes_agree():
    w = Words(pa.array(["a b c d a b c", "a b c"]))
    once, twice = windows(w.codes(), 3)
    assert once[0] == once[4] == once[7] and twice[0] == twice[4] and len({*once[:5].tolist()}) == 4


def test_shingle_sets():
    texts = ["a b c a b c d", "x", "x y", "", "a b c"]
    values, first = shingle_sets(Words(pa.array(texts)), 3)
    assert np.diff(first).tolist() == [len(edge.shingle_set(t, 3)) for t in texts]
    assert values[first[4]] in values[first[0] : first[1]]


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + rng.randrange(50)) for _ in range(60)] + [(7, 7), (300, 200), (200, 300)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {x for e in edges if e[0] != e[1] for x in e}
    assert got == edge.components(sorted(ids), [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _variants(seed: int, n: int) -> list[str]:
    """Families of texts that differ in a few words, and some short ones."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([2, 3, 9, 20, 60, 150]))]
        for _ in range(rng.randrange(1, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = f"W{rng.randrange(400)}"
            out.append(" ".join(copy))
    return out[:n]


def _expected(rows: list[tuple], k: int, percent: int) -> Counter:
    texts = [r[1] for r in rows]
    label = edge.components(list(range(len(rows))), edge.linked_pairs(texts, k, percent))
    ids = defaultdict(list)
    for i, root in label.items():
        ids[root].append(rows[i][0])
    least = {root: min((x for x in found if x is not None), default=None) for root, found in ids.items()}
    return Counter((r[0], len(edge.shingle_set(r[1], k)), least[label[i]]) for i, r in enumerate(rows))


@pytest.mark.parametrize(("k", "percent", "cluster"), [(3, 90, 1 << 22), (5, 80, 1 << 22), (3, 80, 300), (2, 60, 1 << 22)])
def test_join_matches_all_pairs(spark, k, percent, cluster):
    rows = [(i, t) for i, t in enumerate(_variants(k * percent, 260))] + [(None, "w1 w2 w3 w4 w5 w6"), (3, "w1 w2 w3 w4 w5 w6"), (900, None), (901, "")]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), k, percent, cluster_shingles=cluster)
    assert Counter(map(tuple, got.collect())) == _expected(rows, k, percent)


def test_join_of_edge_documents(docs):
    got = ngram_join.near_duplicates(docs, 3, 90)
    assert Counter(map(tuple, got.collect())) == _expected(edge.documents(), 3, 90)
    assert ngram_join.near_duplicates(docs.filter("false")).count() == 0
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").distinct().collect() if r["doc_id"] is not None) == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15, 16]
    assert ngram_join.keep_one_of_each(docs.filter("false")).count() == 0


def test_one_row_of_each_component_is_kept(spark):
    def near(seed: int, place: int) -> str:
        w = edge.prose(seed, 120).split()
        w[place] = "other"
        return " ".join(w)

    a, b, c, d = (edge.prose(seed, 120) for seed in (31, 32, 33, 34))
    rows = [(3, a, 0), (5, near(31, 3), 0), (5, b, 0), (None, near(31, 60), 0)]  # id 5 twice, one a near copy; a near copy without id
    rows += [(None, c, 0), (None, near(33, 3), 0), (None, near(33, 9), 0)]  # a group of null ids
    rows += [(8, d, 1), (8, d, 2), (8, near(34, 3), 0), (9, near(34, 3), 0)]  # the smallest id shared, with one text and with two
    rows += [(3, "", 0), (None, None, 0), (None, None, 0), (None, edge.prose(35, 90), 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row int").repartition(4)
    kept = [tuple(r) for r in ngram_join.keep_one_of_each(frame).collect()]
    assert Counter(kept) == Counter(map(tuple, ngram_join.keep_one_of_each(frame.repartition(3)).collect()))
    groups = [{a, near(31, 3), near(31, 60)}, {c, near(33, 3), near(33, 9)}, {d, near(34, 3)}]
    found = [[r for r in kept if r[1] in g] for g in groups]
    assert found[0] == [(3, a, 0)] and len(found[1]) == 1 and [r[0] for r in found[2]] == [8]
    assert Counter(r for r in kept if not any(r[1] in g for g in groups)) == Counter([(5, b, 0), *rows[-4:]])


def test_one_of_repeated_rows_is_kept(spark):
    text = edge.prose(36, 120)
    rows = [(8, text, i) for i in range(40)] + [(None, text, 40), (9, text, 41), (8, edge.prose(37, 90), 42)]
    kept = ngram_join.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, row int").repartition(4)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(8, text), (8, rows[-1][1])])


def test_search_reaches_long_chains():
    chain = [np.arange(i, i + 40, dtype=np.uint64) for i in range(30)]
    links = ngram_join.spanning_links(np.arange(30), chain, 90)
    assert sorted(a for a, _ in links) == list(range(1, 30)) and {b for _, b in links} == {0}


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_size_classes_are_neighbours(percent):
    for n in range(1, 3000):
        m = n * 100 // percent
        a, b = ngram_join.size_class(np.array([n, m]), percent)
        assert abs(a - b) <= 1


def _check_removal(rows, got, window):
    want = Counter()
    for r, kept in zip(rows, edge.kept_words([r[1] for r in rows], window), strict=True):
        n = len(edge.words(r[1]))
        want[r[0], n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == want


@pytest.mark.parametrize(("window", "prefix", "limit"), [(35, 8, 20_000), (5, 3, 20_000), (5, 3, 1), (4, 4, 2), (1, 1, 5)])
def test_removal_matches_plain_python(spark, window, prefix, limit):
    rng = random.Random(window * 31 + limit)
    passages = [" ".join(f"p{rng.randrange(60)}" for _ in range(rng.choice([3, 6, 40]))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [" ".join(f"u{rng.randrange(5000)}" for _ in range(rng.randrange(0, 30))) for _ in range(3)]
        for _ in range(rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts)), rng.choice(passages))
        rows.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    rows += [(None, rows[0][1]), (5, rows[5][1]), (500, None), (501, ""), (502, "p1 " * 90)]
    got = substring_dedup.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4), window, prefix=prefix, group_limit=limit
    ).collect()
    _check_removal(rows, got, window)
    for r in got:
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["removed"])
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]


def test_removal_of_edge_documents(docs):
    _check_removal(edge.documents(), substring_dedup.remove_repeats(docs).collect(), 35)
    assert substring_dedup.remove_repeats(docs.filter("false")).count() == 0


def test_copies_of_a_text_are_told_once_per_task_and_dealt_apart(spark):
    text, window, prefix = edge.prose(21, 400), 35, 8
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text.encode()])], names=["h1", "text"])
    (found,) = substring_dedup._count_prefixes(window, prefix)(iter([batch]))
    lists = [(p, False) for p in found.column("prefix").to_pylist()]
    schema = "h1 long, h2 long, text binary, prefixes array<struct<prefix:bigint,frequent:boolean>>"
    copies = spark.createDataFrame([(1, 2, bytearray(text.encode()), lists)] * 300, schema).repartition(3)
    rows = copies.mapInArrow(substring_dedup._deal_runs(window, prefix), substring_dedup._SCHEMA).collect()
    known = [r for r in rows if r["kind"] == substring_dedup._KNOWN]
    ranges = {(r["h1"], r["h2"], r["start"], r["n"]) for r in known}
    assert sum(n for *_, n in ranges) == 400 - window + 1
    assert len(known) == 3 * len(ranges) and sorted(Counter(r["prefix"] for r in known).values()) == [len(ranges)] * 3


def test_removal_of_many_copies(spark):
    rows = [(i, edge.prose(22 + i % 3 * (i % 7 == 0), 90)) for i in range(200)] + [(900, edge.prose(50, 60))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    _check_removal(rows, substring_dedup.remove_repeats(frame).collect(), 35)


@pytest.mark.parametrize("seed", range(6))
def test_suffix_trees_match_plain_python(seed):
    rng = random.Random(seed)
    texts = [[f"w{rng.randrange(3)}" for _ in range(rng.randrange(1, 14))] for _ in range(9)] + [["a"] * 12, ["solo"], []]
    trees = substring_dedup.SuffixTrees(pa.array([" ".join(t).encode() for t in texts], pa.large_binary()))
    places = {}
    for t, words in enumerate(texts):
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                places.setdefault(tuple(words[i:j]), set()).add((t, i))
    # right-maximal: two or more occurrences, and no word that follows all of them
    def after(at, n):
        return {(texts[t][i + n],) if i + n < len(texts[t]) else (t, "end") for t, i in at}

    want = {(len(r), frozenset(at)) for r, at in places.items() if len(at) > 1 and len(r) >= 2 and len(after(at, len(r))) > 1}
    number = {int(first) + i: (t, i) for t, first in enumerate(trees.first) for i in range(len(texts[t]))}
    assert {(depth, frozenset(number[p] for p in below.tolist())) for depth, below in trees.internal_nodes(2)} == want
    # maximal ranges: the longest repeat that begins at a word, unless it lies in the one from the word before
    longest = [[max((n for n in range(1, len(w) - i + 1) if len(places[tuple(w[i : i + n])]) > 1), default=0) for i in range(len(w))] for w in texts]
    ranges = [(t, i, n) for t, row in enumerate(longest) for i, n in enumerate(row) if n >= 2 and (i == 0 or row[i - 1] - 1 < n)]
    got = trees.maximal_ranges(np.array([len(w) for w in texts]), 2)
    assert list(zip(*(c.tolist() for c in got), strict=True)) == ranges


def test_frequent_prefixes_are_lengthened(spark):
    """A prefix of 8 words in every text; 16 words tell the repeats apart, and some need all 35."""
    head, deep = edge.prose(70, 8), edge.prose(71, 60)
    tails = [edge.prose(80 + i, 60) for i in range(20)]
    texts = [f"{edge.prose(200 + i, 15)} {head} {tails[i % 20]}" for i in range(60)] + [f"{edge.prose(300 + i, 20)} {deep}" for i in range(40)]
    rows = [(i, text) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keyed = frame.select(F.xxhash64("text").alias("h1"), F.col("text").cast("binary").alias("text"))
    alive, n_lengths = substring_dedup._repeated_prefixes(keyed, 35, 8, 30)
    assert n_lengths == 3 and substring_dedup._lengths(35, 8) == [8, 16, 32]
    assert {r["frequent"]: r["n"] > 0 for r in alive.groupBy("frequent").agg(F.count("*").alias("n")).collect()} == {True: True, False: True}
    assert substring_dedup._repeated_prefixes(keyed, 35, 8, 1000)[1] == 1
    for limit in (30, 2):
        _check_removal(rows, substring_dedup.remove_repeats(frame, group_limit=limit).collect(), 35)


def test_prefixes_beyond_the_bound_become_whole_windows(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FREQUENT_LIMIT", 1)
    rows = [(i, f"{edge.prose(400 + i, 10)} {edge.prose(72 + i % 3, 70)}") for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    _check_removal(rows, substring_dedup.remove_repeats(frame, group_limit=2).collect(), 35)


def test_groups_are_never_split():
    rows = [(k, b"x" * 50) for k in range(40) for _ in range(1 + k % 7 * 30)]
    table = pa.table({"k": pa.array([r[0] for r in rows], pa.int64()), "t": pa.array([r[1] for r in rows])})
    parts = list(substring_dedup._whole_groups(iter(table.to_batches(max_chunksize=37)), "k", 2_000))
    assert pa.concat_tables(parts).equals(table.combine_chunks()) or pa.concat_tables(parts).to_pylist() == table.to_pylist()
    edges = [(p.column("k")[0].as_py(), p.column("k")[-1].as_py()) for p in parts]
    assert len(parts) > 3 and all(a[1] < b[0] for a, b in zip(edges, edges[1:], strict=False))


def test_repeated_rows_become_one_set(spark):
    """Rows with one id and text share a node; they reach the search as one set, in few rows before."""
    text = edge.prose(3, 200)
    near = text.replace(text.split()[7], "other")
    rows = [edge.row(None, text)] * 3000 + [edge.row(5, near)]
    docs = ngram_join._documents(spark.createDataFrame(rows, edge.SCHEMA).repartition(4), "text", "doc_id")
    named = docs.withColumn("node", F.when(F.col("doc_id").isNull(), 1).otherwise(2).cast("long"))
    per_task = named.select("node", "text").mapInArrow(ngram_join._node_sets(5), "node long, n long, shingles binary")
    assert per_task.count() <= 5
    assert ngram_join._one_set_per_node(named, 5, 2).count() == 2
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, edge.SCHEMA)).groupBy("component_id").count().collect()
    assert [(r["component_id"], r["count"]) for r in got] == [(5, 3001)]
