"""Vector codes: the tree and the whole operator against plain Python."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakemart.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, code string, n long"


@pytest.mark.parametrize("largest", [3, 400, 1 << 26])
def test_tree_finds_the_first_nearest_entry(largest):
    draw = np.random.default_rng(largest)
    for n, spread in ((1, 1), (5, 1), (40, 1), (256, 1), (256, 40)):
        centres = draw.integers(-largest, largest + 1, (n, 6))
        entries = np.clip(centres // spread * spread, -largest, largest)
        queries = np.concatenate([draw.integers(-largest, largest + 1, (500, 6)), entries, entries + 1])
        index, distance = vector_codes.Gnat(entries).nearest(queries)
        exact = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(q, e, strict=True)) for e in entries] for q in queries[:80]])
        assert (index[:80] == exact.argmin(1)).all() and (distance[:80] == exact.min(1)).all()
        every = ((queries[:, None, :] - entries[None]) ** 2).sum(2)
        assert (index == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_tree_leaves_subtrees_out():
    draw = np.random.default_rng(1)
    centres = draw.integers(-10_000, 10_000, (16, 8))
    entries = (centres[:, None, :] + draw.integers(-50, 50, (16, 16, 8))).reshape(256, 8)
    tree = vector_codes.Gnat(entries)
    queries = entries[draw.integers(0, 256, 1000)] + draw.integers(-30, 30, (1000, 8))
    index, _ = tree.nearest(queries)
    assert (index == vector_codes.squared_distances(queries, entries).argmin(1)).all()
    assert tree.compared < 60 * len(queries)


def test_equal_entries_are_one_leaf():
    index, distance = vector_codes.Gnat(np.ones((256, 4), dtype=np.int64)).nearest(np.array([[1, 1, 1, 3]]))
    assert (index[0], distance[0]) == (0, 4)


def plain(rows, parts, entries, rounds, scale=1024):
    """Codes, errors and codebooks by the rules, in plain Python."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return [], None
    whole = [(r[0], r[2], [math.floor(scale * x) for x in r[1]]) for r in kept]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, b"".join(x.to_bytes(4, "little", signed=True) for x in r[2])))
    width = len(whole[0][2])
    step = width // parts
    same = [r for r in whole if len(r[2]) == width]

    def cut(x, p):
        return x[p * step : (p + 1) * step]

    books = [[cut(r[2], p) for r in same[:entries]] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [defaultdict(list) for _ in range(parts)]
        for r in same:
            for p in range(parts):
                found[p][nearest(cut(r[2], p), p)[1]].append(cut(r[2], p))
        for p in range(parts):
            for e, members in found[p].items():
                books[p][e] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    out = []
    for vec_id, label, x in whole:
        if len(x) != width:
            out.append((vec_id, None, None, label))
            continue
        best = [nearest(cut(x, p), p) for p in range(parts)]
        out.append((vec_id, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), label))
    totals = defaultdict(int)
    for _, _, error, label in out:
        totals[label] += error or 0
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return [(i, code, error, totals[label], digest) for i, code, error, label in out], digest


def vectors():
    draw = random.Random(5)
    rows = [(i, [draw.gauss(i % 5, 0.3) for _ in range(8)], i % 7 or None, "v", "c", 1) for i in range(300)]
    rows += [(i, None, 1, "v", "c", 1) for i in (400, None)]
    rows += [(401, [1.0] * 7 + [None], 1, "v", "c", 1), (402, [float("nan")] * 8, 1, "v", "c", 1), (403, [float("-inf")] + [0.0] * 7, 2, "v", "c", 1)]
    rows += [(None, [0.25] * 8, 3, "v", "c", 1), (404, [0.5] * 4, 3, "v", "c", 1), (405, [], None, "v", "c", 1)]
    rows += [(7, [1.5] * 8, 2, "v", "c", 1)] * 3 + [(500 + i, [-0.0001] * 8, 2, "v", "c", 1) for i in range(200)]
    # As 32-bit numbers, which is what the column holds.
    return [(i, x and [None if v is None else float(np.float32(v)) for v in x], *rest) for i, x, *rest in rows]


@pytest.mark.parametrize(("entries", "rounds"), [(256, 4), (20, 2), (600 % 256, 1)])
def test_codes_match_plain_python(spark, entries, rounds):
    rows = vectors()
    want, _ = plain(rows, 4, entries, rounds)
    got = vector_codes.code_report(spark.createDataFrame(rows, SCHEMA).repartition(5), entries=entries, rounds=rounds).collect()
    assert Counter(tuple(r) for r in got) == Counter(want)


def test_no_vectors(spark):
    table = spark.createDataFrame(vectors(), SCHEMA)
    empty = vector_codes.code_report(table.filter("false"))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    assert vector_codes.code_report(table.filter("embedding IS NULL")).count() == 0


def test_what_cannot_be_coded_is_an_error(spark):
    with pytest.raises(ValueError, match="do not divide"):
        vector_codes.code_report(spark.createDataFrame([(1, [0.5] * 6, 1)], "vec_id long, embedding array<float>, label int"))
    with pytest.raises(Exception, match="beyond"):
        vector_codes.code_report(spark.createDataFrame([(1, [1e30] * 8, 1)], "vec_id long, embedding array<float>, label int")).count()


def test_tasks_pass_on_a_row_per_entry_only(spark):
    """A vector that is most of the table costs no more than any other."""
    rows = [(i, [0.5] * 8 if i % 10 else [i / 7] * 8, 1) for i in range(3000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    books = np.zeros((4, 16, 2), dtype=np.int64)
    whole = table.withColumnRenamed("embedding", "vector")
    stored = vector_codes._stored(whole.mapInArrow(vector_codes._whole_vectors(1024), "vec_id long, label int, width int, vector binary"), "t")
    sent = spark.sparkContext.broadcast(books)
    sums = stored.select("vector").mapInArrow(vector_codes._sums(sent, 8), "part long, entry long, n long, total array<long>")
    assert sums.count() <= 4 * 3 and sums.groupBy().sum("n").first()[0] == 4 * 3000
