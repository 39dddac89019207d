"""Near duplicates by odd sketches: parts, and the whole against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import odd_sketch
from tests.llm import edge


def plain(rows, k, percent):
    texts = [r[1] for r in rows]
    label = edge.components(list(range(len(rows))), edge.linked_pairs(texts, k, percent))
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in label if label[j] == label[i] and rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((r[0], len(edge.shingle_set(r[1], k)), component, r[0] == component))
    return Counter(out)


def families(seed, n_families, n_members, n_words, least, most):
    """Texts of which the members of a family share about so many words."""
    draw = random.Random(seed)
    rows = []
    for family in range(n_families):
        base = edge.prose(1000 * seed + family, n_words).split()
        for _ in range(n_members):
            words = list(base)
            for _ in range(draw.randint(least, most)):
                words[draw.randrange(n_words)] = format(draw.getrandbits(40), "x")
            rows.append(" ".join(words))
    draw.shuffle(rows)
    return [edge.row(i, text) for i, text in enumerate(rows)]


def sets_of(similarity, size=400, seed=3):
    """Two sets of random codes with the given Jaccard similarity."""
    draw = np.random.default_rng(seed)
    both = round(similarity * size)
    codes = draw.integers(1, 2**63, 2 * size, dtype=np.uint64)
    rest = (size - both) // 2
    return np.unique(codes[: both + rest]), np.unique(np.concatenate([codes[:both], codes[size : size + size - both - rest]]))


def signature(*sets):
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    samples = odd_sketch.min_hashes(np.concatenate(sets), first)
    return samples, odd_sketch.odd_sketches(samples), odd_sketch.band_keys(samples)


@pytest.mark.parametrize("similarity", [0.6, 0.8, 0.9, 0.97])
def test_sketches_estimate_similarity(similarity):
    estimates, agree = [], []
    for seed in range(60):
        samples, sketches, _ = signature(*sets_of(similarity, seed=seed))
        estimates.append(odd_sketch.estimated_similarity(float(odd_sketch.differing_bits(sketches[0], sketches[1]))))
        agree.append((samples[0] == samples[1]).mean())
    assert abs(np.mean(estimates) - similarity) < 0.02 and np.std(estimates) < 0.06
    assert abs(np.mean(agree) - similarity) < 0.02


def test_sketch_holds_parities():
    samples, sketches, _ = signature(*sets_of(0.5))
    bits = (odd_sketch.mix(samples ^ odd_sketch._NUMBER) >> np.uint64(54)).astype(int)
    for row, sketch in zip(bits, sketches, strict=True):
        odd = {b for b, n in Counter(row.tolist()).items() if n % 2}
        assert {b for b in range(odd_sketch.BITS) if int(sketch[b // 64]) >> b % 64 & 1} == odd


def test_bound_admits_every_linked_pair():
    """Far below the bound at the threshold, and above it for sets that are far apart."""
    limit = odd_sketch.most_different_bits(80)
    near, far = [], []
    for seed in range(300):
        for similarity, into in ((0.8, near), (0.2, far)):
            _, sketches, keys = signature(*sets_of(similarity, 200, seed))
            into.append((odd_sketch.differing_bits(sketches[0], sketches[1]), bool((keys[0] == keys[1]).any())))
    assert all(bits <= limit and shared for bits, shared in near)
    assert all(bits > limit for bits, _ in far)
    assert odd_sketch.most_different_bits(95) < limit < odd_sketch.most_different_bits(60)
    assert odd_sketch.most_different_bits(100) == 0


@pytest.mark.parametrize(("k", "percent"), [(4, 80), (5, 80), (3, 90)])
def test_edge_rows(spark, k, percent):
    rows = edge.documents()
    got = odd_sketch.near_duplicates(spark.createDataFrame(rows, edge.SCHEMA).repartition(3), k, percent).collect()
    out = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got)
    assert out == Counter({(i, n, c, i == c): v for (i, n, c, _), v in plain(rows, k, percent).items()})


@pytest.mark.parametrize("cluster_shingles", [odd_sketch.CLUSTER_SHINGLES, 2000])
@pytest.mark.parametrize("changes", [(0, 5), (2, 3)])
def test_families_match_all_pairs(spark, monkeypatch, cluster_shingles, changes):
    """Families whose members are linked through others only, whole and split into blocks of few sets."""
    if cluster_shingles < odd_sketch.CLUSTER_SHINGLES:
        monkeypatch.setattr(odd_sketch, "KEY_NODES", 8)
    rows = families(7, 4, 60, 120, *changes)
    got = odd_sketch.near_duplicates(spark.createDataFrame(rows, edge.SCHEMA).repartition(4), 4, 80, cluster_shingles=cluster_shingles).collect()
    want = plain(rows, 4, 80)
    assert Counter(map(tuple, got)) == want
    assert 4 < sum(kept for *_, kept in want) < 240


def test_copies_and_null_ids_cost_one_set(spark):
    """Rows with one id and text become one set per task, however many there are."""
    text = edge.prose(3, 200)
    near = text.replace(text.split()[7], "other")
    rows = [edge.row(None, text)] * 2000 + [edge.row(5, near), edge.row(9, text)]
    docs = spark.createDataFrame(rows, edge.SCHEMA).repartition(3)
    got = odd_sketch.near_duplicates(docs).groupBy("component_id", "kept").count().collect()
    assert {(r["component_id"], r["kept"]): r["count"] for r in got} == {(5, True): 1, (5, False): 2001}
    named = docs.select(F.lit(1).cast("long").alias("node"), F.lit(1).cast("long").alias("cluster"), "text")
    sets = named.mapInArrow(odd_sketch._node_sets(5), "node long, cluster long, n long, shingles binary, sketch array<long>")
    assert sets.count() <= 3


def test_a_group_of_near_copies_sends_each_set_to_few_tasks(spark):
    """Blocks of one large component meet a common set only; nothing is dealt to pairs of blocks."""
    rows = families(5, 1, 300, 150, 0, 2)
    docs = spark.createDataFrame(rows, edge.SCHEMA)
    named = docs.select(F.col("doc_id").alias("node"), F.lit(0).cast("long").alias("cluster"), "text")
    sets = odd_sketch.stored(named.mapInArrow(odd_sketch._node_sets(4), "node long, cluster long, n long, shingles binary, sketch array<long>"), "sets")
    dealt = []
    original = odd_sketch._searched

    def counted(rows, *rest):
        dealt.append(rows.count())
        return original(rows, *rest)

    odd_sketch._searched = counted
    try:
        found = odd_sketch.linked_components(sets, 80, cluster_shingles=3000)
    finally:
        odd_sketch._searched = original
    assert found.select("component").distinct().count() == 1 and found.count() == 300
    assert dealt[0] < 300 + 40 and sum(dealt[1:]) == 0


def test_empty_table(spark):
    docs = spark.createDataFrame(edge.documents(), edge.SCHEMA)
    got = odd_sketch.near_duplicates(docs.filter("false"))
    assert got.count() == 0 and got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert odd_sketch.near_duplicates(docs.filter("text IS NULL")).count() == 2
