"""Registered queries against their SQL, and the pipeline, on the smallest tables."""

import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from lakemart.llm import mixing
from lakemart.llm.queries import QUERIES, SQL
from tests.llm import edge
from tests.llm.check_sql import connect, difference

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_registered():
    names = [f"op{n}_" for n in range(1, 11)]
    assert all(any(q.startswith(n) for q in driver.queries()) for n in names)
    assert "pipeline" in driver.queries() and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, FOLDER), connection.execute(SQL[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_returns_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def _write(spark, folder, rows):
    docs = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")


def _expected_before_mix(rows):
    """Plain Python for the first three stages."""
    kept = [r for r in rows if not edge.failed_rules(r[1])]
    largest = {}
    for r in kept:
        if r[1] not in largest or (r[0] is not None and (largest[r[1]][0] is None or r[0] > largest[r[1]][0])):
            largest[r[1]] = r
    kept = list(largest.values())
    label = edge.components(list(range(len(kept))), edge.linked_pairs([r[1] for r in kept], 5, 80))
    groups = defaultdict(list)
    for i, root in label.items():
        groups[root].append(kept[i])
    return [min(g, key=lambda r: (r[0] is None, r[0])) for g in groups.values()]


def test_pipeline_stages(spark, tmp_path):
    rows = [r for r in edge.documents() if r[0] != 14] + [edge.row(100 + i, edge.prose(50 + i, 90), "abc"[i % 3]) for i in range(20)]
    _write(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        docs.write.parquet(f"{tmp_path}/stage{i}")
        docs = spark.read.parquet(f"{tmp_path}/stage{i}")
    want = _expected_before_mix(rows)
    assert Counter((r["doc_id"], r["text"]) for r in docs.collect()) == Counter((r[0], r[1]) for r in want)
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, str(tmp_path))
    assert mixed.columns == columns
    mixed.write.parquet(f"{tmp_path}/mixed")
    mixed = spark.read.parquet(f"{tmp_path}/mixed")
    sizes = Counter()
    for r in want:
        sizes[r[3]] += len(edge.words(r[1]))
    order = sorted(sizes)
    goal = mixing.targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()), 2)
    taken = Counter()
    for r in mixed.collect():
        taken[r["source"]] += len(edge.words(r["text"]))
    for source, amount in zip(order, goal, strict=True):
        assert abs(taken[source] - amount) <= 2 * mixing.BLOCK_WORDS
    packed = corpus_pipeline.STAGES[4][1](spark, mixed, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in packed).keys() == {r["doc_id"] for r in mixed.collect()}
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in packed)


def test_pipeline_runs_whole(spark, tmp_path):
    _write(spark, tmp_path, edge.documents())
    once, again = (Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) for _ in range(2))
    assert once and once == again
