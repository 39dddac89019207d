"""The mix against a plain Python version: draws, quotas, permutations and blocks, row for row."""

from collections import Counter

import pytest
import xxhash

from lakemart.llm import mixing
from tests.llm import edge


class Int(int):
    """A 32-bit number, which hashes as four bytes."""


def h(*values):
    """Hash of a row of values: each is hashed with the hash so far as seed, null leaves it as it is."""
    code = 42
    for v in values:
        if v is None:
            continue
        data = v.encode() if isinstance(v, str) else int(v).to_bytes(4 if isinstance(v, Int) else 8, "little", signed=True)
        code = xxhash.xxh64_intdigest(data, seed=code)
    return code - 2**64 if code >= 2**63 else code


def ceil_sqrt(n):
    side = int(n**0.5)
    while side * side < n:
        side += 1
    return side


def permuted(index, n, key):
    side = ceil_sqrt(n)
    value = index
    while True:
        a, b = divmod(value, side)
        for turn in range(4):
            a, b = b, (a + h(b, Int(turn), key) % side) % side
        value = a * side + b
        if value < n:
            return value


def plain_mix(rows, block_words, shard_slots, chunk_rows, seed):
    """``(shard, slot, doc_id, source, pass, from_word, n_words)`` of every piece that the mix takes."""
    sized = [(r[0], r[3], len(edge.words(r[1])), h(r[1] or "")) for r in rows]
    order = sorted({s for _, s, _, _ in sized}, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for _, s, n, _ in sized if s == source) for source in order]
    wanted = mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(sizes), 2)
    blocks = [-(-n // block_words) for n in sizes]
    quota = [min(2 * b, round(t * b / n)) if n else 0 for b, t, n in zip(blocks, wanted, sizes, strict=True)]
    total = sum(quota)

    def number_of(bounds, value):
        done = 0
        for i, n in enumerate(bounds):
            done += n
            if value < done:
                return i
        raise AssertionError

    # Draws in order, each with its number among its source's.
    drawn, counts = [], [0] * len(order)
    for i in range(total):
        number = number_of(quota, h(f"draw {seed}", i) % total)
        drawn.append((i, number, counts[number]))
        counts[number] += 1
    # What a source drew beyond its quota goes, in order of sources and draws, to those that drew too little.
    lacking = [slot for n, (c, q) in enumerate(zip(counts, quota, strict=True)) for slot in [(n, j) for j in range(c, q)]]
    extra = sorted((n, j, i) for i, n, j in drawn if j >= quota[n])
    place = {i: (n, j) for i, n, j in drawn}
    for (_, _, i), to in zip(extra, lacking, strict=True):
        place[i] = to
    # Streams of words, documents in a pseudorandom order by chunk.
    chunks = max(1, -(-len(rows) // chunk_rows))
    pieces = {}
    for n, source in enumerate(order):
        stream = [(h(f"stream {seed}", d, c), d, c, size) for d, s, size, c in sized if s == source and size]
        stream.sort(key=lambda x: (x[0] % chunks, x[0], x[1] is not None, x[1] or 0, x[2]))
        start = 0
        for _, d, _, size in stream:
            for block in range(start // block_words, (start + size - 1) // block_words + 1):
                begin, end = max(start, block * block_words), min(start + size, (block + 1) * block_words)
                pieces.setdefault((n, block), []).append((d, source, begin - start, end - begin))
            start += size
    out = Counter()
    for i, (n, j) in place.items():
        turn, index = divmod(j, blocks[n])
        block = permuted(index, blocks[n], h(f"permutation {seed}", Int(n), turn))
        for d, source, begin, length in pieces[n, block]:
            out[i // shard_slots, i % shard_slots, d, source, turn, begin, length] += 1
    return out


@pytest.mark.parametrize(("block_words", "shard_slots", "chunk_rows", "seed"), [(16, 64, 20_000, 1), (256, 1024, 20_000, 1), (7, 5, 3, 2)])
def test_mix_matches_plain_python(spark, monkeypatch, block_words, shard_slots, chunk_rows, seed):
    monkeypatch.setattr(mixing, "_CHUNK_ROWS", chunk_rows)
    rows = [r for r in edge.documents() if len(r[1] or "") < 100_000] + [edge.row(100 + i, edge.prose(50 + i, 40 + 13 * i), "abd"[i % 3]) for i in range(9)]
    docs = spark.createDataFrame(rows, edge.SCHEMA).repartition(4)
    got = mixing.shard_table(docs, seed=seed, block_words=block_words, shard_slots=shard_slots).collect()
    want = plain_mix(rows, block_words, shard_slots, chunk_rows, seed)
    assert Counter((r["shard"], r["slot"], r["doc_id"], r["source"], r["pass"], r["from_word"], r["n_words"]) for r in got) == want
    taken = Counter()
    for (_, _, d, source, _, _, n), times in want.items():
        taken[d, source] += n * times
    report = Counter()
    for r in mixing.mix_report(docs, seed=seed, block_words=block_words, shard_slots=shard_slots).collect():
        report[r["doc_id"], r["source"]] += r["taken"]
    assert +report == +taken


def test_hash_is_sparks(spark):
    got = spark.sql("SELECT xxhash64('a', 5L, CAST(7 AS INT), CAST(NULL AS BIGINT), -3L) AS h").first()["h"]
    assert got == h("a", 5, Int(7), None, -3)
