"""Operators on token ids: encoder, packing, counts, files."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakemart.llm import packing, token_counts, token_files, token_ids
from tests.llm import edge


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge.documents(), edge.SCHEMA)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(token_ids.default_tokenizer())
    tokenizer.encode_special_tokens = True

    def ids(text):
        return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")

    return ids


ODD = ["", " ", "a", " a", "a ", "a\nb", "a\n b", "a  b", "\n", "a\n\nb", "a\tb", "<|endoftext|> x", "don't 's x", "a\x00b c", "a\x1cb", "x　y", "a\x85b c", "٣ ४ x", "foo\r\nbar", "Ǆ中 文,字", "a.b, ?!\n..."]


def test_encoder_agrees_with_the_library(library):
    encoder = token_ids.Encoder(token_ids.default_tokenizer())
    rng = random.Random(1)
    texts = [*ODD, *("".join(rng.choice("ab1é'.,!s t\n \x1f中") for _ in range(rng.randrange(14))) for _ in range(3000))]
    assert [x + token_ids.END for x in encoder.encode(texts)] == [library(t).tobytes() for t in texts]


def test_encoder_forgets_and_agrees(library):
    texts = [edge.prose(i, 30) for i in range(4)]
    assert [x + token_ids.END for x in token_ids.Encoder(token_ids.default_tokenizer(), 5).encode(texts)] == [library(t).tobytes() for t in texts]


def test_other_tokenizers_go_whole():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, plain = token_ids.Encoder(path), Tokenizer.from_file(path)
    assert encoder.pieces is None
    assert np.frombuffer(encoder.encode(["Some words, here"])[0], "<u4").tolist() == plain.encode("Some words, here", add_special_tokens=False).ids


@pytest.mark.parametrize("longest", [1024, 8, 1])
def test_packing(docs, library, longest):
    pieces = packing.pack(docs, longest=longest).collect()
    by_document = Counter()
    for r in pieces:
        assert r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0 and r["length"] <= longest
        by_document[r["doc_id"], r["start"], r["length"], r["doc_tokens"], bytes(r["ids"])] += 1
    want = Counter()
    for doc in edge.documents():
        ids, at = library(doc[1]), 0
        for n in packing.piece_lengths(len(ids), longest):
            want[doc[0], at, n, len(ids), ids[at : at + n].tobytes()] += 1
            at += n
        assert at == len(ids)
    assert by_document == want
    assert len({r["sequence_id"] for r in pieces}) == len(pieces)


def test_sequences_and_buckets(docs, spark, library, tmp_path):
    sequences = packing.training_sequences(docs)
    for r in sequences.collect():
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    packing.write_buckets(sequences, str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b/bucket=6")).select(F.size("ids")).distinct().collect()[0][0] == 64
    assert packing.training_sequences(docs.filter("false")).count() == packing.pack_report(docs.filter("false")).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(docs, longest=1000)


def test_batches_hold_pieces_of_one_bucket(docs):
    pieces = packing.pack(docs.repartition(3)).collect()
    by_batch, by_bucket = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert r["length"] == 1 << r["bucket"]
        by_batch[r["batch"]].append(r["length"])
        by_bucket[r["bucket"]].append(r["batch"])
    assert all(len(set(lengths)) == 1 and sum(lengths) <= packing.BATCH_TOKENS for lengths in by_batch.values())
    for bucket, batches in by_bucket.items():
        assert len(set(batches)) <= len(batches) // (packing.BATCH_TOKENS >> bucket) + 3
    assert any(len(lengths) > 10 for lengths in by_batch.values())


@pytest.mark.parametrize("by", [(), ("source",)])
def test_counts(docs, library, by):
    lengths = [(r[3] if by else None, len(library(r[1]))) for r in edge.documents()]
    histogram = token_counts.length_histogram(docs, by)
    got = token_counts.suffix_sums(histogram, by).collect()
    assert Counter({(r["source"] if by else None, r["n_tokens"]): r["n_documents"] for r in got}) == Counter(lengths)
    for r in got:
        own = [n for s, n in lengths if not by or s == r["source"]]
        limit = r["n_tokens"]
        assert r["documents_at_least"] == sum(n >= limit for n in own)
        assert r["tokens_at_least"] == sum(n for n in own if n >= limit)
        assert (r["total_tokens"], r["truncated_total"]) == (sum(own), sum(min(n, limit) for n in own))
        assert r["rank"] == pytest.approx(sum(n <= limit for n in own) / len(own))
    if not by:
        every = sorted(n for _, n in lengths)
        assert token_counts.quantile(token_counts.suffix_sums(histogram), 0.5).first()[0] == every[-(-len(every) // 2) - 1]
        assert token_counts.truncated_total(histogram, 100).first()[0] == sum(min(n, 100) for n in every)


def test_counts_of_nothing(docs):
    empty = token_counts.length_histogram(docs.filter("false"))
    assert empty.count() == 0 and token_counts.suffix_sums(empty).count() == 0
    assert token_counts.quantile(token_counts.suffix_sums(empty), 0.5).first()[0] is None


def test_files(docs, spark, library, tmp_path):
    path = str(tmp_path / "orc")
    rows = token_files.token_file_report(docs.repartition(3), path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted((r[0] for r in edge.documents()), key=lambda i: (i is not None, i))
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    want = Counter((d[0], len(library(d[1])), zlib.crc32(library(d[1]).tobytes())) for d in edge.documents())
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    found = token_files.read_token_files(spark, path, [7, 15])
    assert sorted(r["doc_id"] for r in found.collect()) == [7, 15]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    assert token_files.token_file_report(docs.filter("false")).count() == 0
