"""Substring deduplication by prefix-partitioned suffix trees.

Words covered by a window of ``window`` words that also starts anywhere else
are removed.  Suffixes begin at words.

1. Every window has an anchor: the place inside it of the ``PREFIX`` words with
   the smallest code, so equal windows have equal anchors.  Neighbouring windows
   share one, which leaves about one anchor in fourteen words.
2. The prefix at an anchor is counted over all documents.  A prefix seen once
   is a leaf of the tree: no window anchored there repeats.  The rest split the
   windows into groups that are built apart, as equal windows share a prefix.
   A prefix seen more often than ``group_limit`` makes a group that does not fit
   a task: its windows are anchored again by prefixes twice as long, and so on,
   counted each time, until a group fits or the prefix is the whole window.
   Equal windows agree at every length, so none is parted from its like.
3. A document sends each anchor's run of windows as one stretch of text to the
   group of its prefix, so a word travels a few times, not once per window.
   Where the prefix is the whole window, one number and a place stand for it.
4. A task takes whole groups up to ``BUILD_WORDS`` words and builds their suffix
   trees: the suffixes in order, with the words that neighbours share.  The
   internal node above a suffix is as deep as the longer of its two shared
   beginnings.  Where that is ``window`` words or more, the path to the node is
   a repeat of that length; those that do not lie inside the one that begins a
   word before are the maximal ones.
5. The maximal repeats go back to their documents, which drop the words they
   cover.  A repeat longer than a stretch comes back as one range per stretch;
   the ranges overlap by all but a word of a window and join there.

Map tasks combine before they send: of equal runs of windows in a task only the
first travels, the others, and then the first too, are known to repeat.  That a
range of a text repeats is sent once per task, however many copies of the text
it holds, and dealt by stretch of the text and task, not by the text.  A passage that
a third of all documents share therefore travels once per task, and a text that
a third of them are costs a row per task and run.

Words are compared by 64-bit codes, whole windows and runs by 128 bits.  Results
hang on a text's content only, so they are keyed by 128 bits of its hash.

Defined results: a null text has no words.  Null ids and repeated rows are
documents like others.  A document of fewer words keeps them all.  An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import salted_join, text_or_empty
from lakemart.llm.words import Words, mix, ranges, shingles, small_batches, windows
from lakemart.sources.paths import scratch_path

WINDOW = 35
PREFIX = 8
GROUP_LIMIT = 20_000
#: Prefixes of one length whose windows are anchored again, at most, since every task holds them (8 MB); with more, the
#: prefix is lengthened to the whole window at once, which gives the same repeats from more rows.
FREQUENT_LIMIT = 1 << 20
#: Words that step 4 sorts at a time, unless one prefix alone has more.
BUILD_WORDS = 1 << 20
#: Equal runs, and ranges known to repeat, that a map task remembers, at most; forgetting one costs a row, not a result.
_REMEMBERED = 200_000
#: Words of a text whose known ranges a map task sends under one key.
_STRETCH = 4_096


def _anchors(words: Words, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts of a batch: number of the first word, place of the anchor, and its prefix code."""
    counts = words.counts
    fitting = np.maximum(counts - window + 1, 0)
    starts = ranges(words.first[:-1], fitting)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    codes = shingles(words.codes(), prefix)
    span = window - prefix + 1
    # smallest code of each ``span`` places, leftmost first, by doubling
    best, width = np.arange(len(codes)), 1
    while width < span:
        step = min(width, span - width)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(codes[left] <= codes[right], left, right)
        width += step
    anchors = best[starts]
    return starts, anchors, codes[anchors]


def _lengths(window: int, prefix: int) -> list[int]:
    """Prefix lengths in the order they are tried; the whole window follows when all are too frequent."""
    lengths = [prefix]
    while 2 * lengths[-1] < window:
        lengths.append(2 * lengths[-1])
    return lengths


class _Places:
    """Windows of a batch, each with the first of some prefix lengths that suits it.

    ``level`` counts the lengths tried before: a length's own index where its
    prefix is listed and not too frequent, their number where all are too
    frequent, -1 where a prefix is not listed.  ``judge`` says of the prefixes
    of a length which are listed and which of those are too frequent.
    """

    def __init__(self, words: Words, window: int, lengths: list[int], judge) -> None:
        fitting = np.maximum(words.counts - window + 1, 0)
        self.starts = ranges(words.first[:-1], fitting)
        self.text = np.repeat(np.arange(len(fitting)), fitting)
        self.level = np.full(len(self.starts), len(lengths))
        self.anchor = self.starts.copy()
        self.code = np.zeros(len(self.starts), np.uint64)
        going = np.arange(len(self.starts))
        for level, length in enumerate(lengths):
            if not len(going):
                break
            _, anchors, codes = _anchors(words, window, length)
            self.anchor[going], self.code[going] = anchors[going], codes[going]
            first = _changes(self.text[going], anchors[going])
            at, size = going[first], np.diff(np.append(first, len(going)))
            listed, frequent = judge(level, self.text[at], self.code[at])
            state = np.where(listed, np.where(frequent, len(lengths), level), -1)
            self.level[going] = np.repeat(state, size)
            going = going[np.repeat(listed & frequent, size)]
        self.anchor[going] = self.starts[going]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Places of rows that differ from the row before in any column, the first row included."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _count_prefixes(window: int, prefix: int, frequent: Sequence[np.ndarray] = ()):
    """Step 2, map side: prefixes of each text, with the number of anchors that have them.

    ``frequent`` holds the sorted codes of the shorter lengths that are too
    frequent; only windows of such a prefix at each of them are anchored.
    """
    *lengths, length = _lengths(window, prefix)[: len(frequent) + 1]

    def judge(level: int, _: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = frequent[level]
        at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
        hit = known[at] == codes if len(known) else np.zeros(len(codes), dtype=bool)
        return hit, hit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words = Words(batch.column("text"))
            places = _Places(words, window, lengths, judge)
            going = np.flatnonzero(places.level == len(frequent))
            if not len(going):
                continue
            _, anchors, codes = _anchors(words, window, length)
            going = going[_changes(places.text[going], anchors[going])]
            codes, text = codes[going], places.text[going]
            order = np.lexsort((codes, text))
            codes, text = codes[order], text[order]
            at = _changes(text, codes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[at].view(np.int64)), batch.column("h1").take(pa.array(text[at])), pa.array(np.diff(np.append(at, len(codes))))],
                names=["prefix", "h1", "n"],
            )

    return run


#: What a row of step 3 is: a run with its text, one window by its codes, or a range known to repeat.
_RUN, _WINDOW, _KNOWN = 0, 1, 2
_SCHEMA = "kind int, prefix long, h1 long, h2 long, start long, n long, text binary"
_TYPES = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
_NAMES = ["kind", "prefix", "h1", "h2", "start", "n", "text"]


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _deal_runs(window: int, prefix: int, n_lengths: int | None = None):
    """Step 3: one row per run of windows whose prefix repeats, less what this task has sent already.

    ``n_lengths`` prefix lengths have been counted, all by default.
    """
    lengths = _lengths(window, prefix)[:n_lengths]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        sent: dict[tuple[int, int], tuple[int, int, int, int] | None] = {}
        known: set[tuple[int, int, int, int]] = set()

        def repeats(me: tuple[int, int, int, int]) -> Iterator[tuple]:
            """The row that says so, unless this task has sent it."""
            if me not in known:
                if len(known) >= _REMEMBERED:
                    known.clear()
                known.add(me)
                yield _KNOWN, hash((me[0], me[2] // _STRETCH, task)), *me, None

        for batch in small_batches(batches, "text"):
            words = Words(batch.column("text"))
            places = _Places(words, window, lengths, _listed(batch))
            alive = np.flatnonzero(places.level >= 0)
            if not len(alive):
                continue
            starts, text, level = places.starts[alive], places.text[alive], places.level[alive]
            # runs: neighbouring windows of one anchor; a window that is its own prefix is a run of its own
            first = _changes(text, level, places.anchor[alive], starts - np.arange(len(starts)))
            length = np.diff(np.append(first, len(starts)))
            codes, text, deep = places.code[alive][first], text[first], level[first] == len(lengths)
            whole = windows(words.codes(), window)
            once, twice = (w[starts] for w in whole)
            inside = ranges(np.zeros(len(length), np.int64), length)
            place = mix(inside.astype(np.uint64))
            flat = ranges(first, length)
            cuts = np.cumsum(length) - length
            ids = [np.add.reduceat(mix(c[flat] ^ place), cuts) if len(flat) else c[:0] for c in (once, twice)]
            h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
            out = []
            columns = (length, text, deep, *ids, once[first], twice[first], codes, starts[first])
            for n, t, is_deep, a, b, code, second, group, start in zip(*(c.tolist() for c in columns), strict=True):
                begin = start - int(words.first[t])
                me = (int(h1[t]), int(h2[t]), begin, n)
                if (a, b) in sent:
                    out += repeats(me)
                    if (before := sent[a, b]) is not None:
                        out += repeats(before)
                        sent[a, b] = None
                    continue
                if len(sent) >= _REMEMBERED:
                    sent.clear()
                sent[a, b] = me
                if is_deep:
                    out.append((_WINDOW, _signed(code), *me, second.to_bytes(8, "little")))
                else:
                    last = start + n + window - 2
                    out.append((_RUN, _signed(group), *me, words.data[words.starts[start] : words.ends[last]].tobytes()))
            if out:
                yield _batch(out, _TYPES, _NAMES)

    return run


def _signed(code: int) -> int:
    return code - (1 << 64) if code >> 63 else code


def _listed(batch: pa.RecordBatch):
    """Which prefixes of a text its list names, and which of those are too frequent."""
    lists = batch.column("prefixes")
    offsets = lists.offsets.to_numpy()
    listed = lists.values.field("prefix").to_numpy().view(np.uint64)[offsets[0] : offsets[-1]]
    frequent = lists.values.field("frequent").to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
    order = np.lexsort((listed, owner))
    owner, listed, frequent = owner[order], listed[order], frequent[order]

    def judge(_: int, text: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = _positions(owner, listed, text, codes)
        hit = at >= 0
        often = np.zeros(len(at), dtype=bool)
        often[hit] = frequent[at[hit]]
        return hit, often

    return judge


def _positions(owner: np.ndarray, listed: np.ndarray, text: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Place of each ``(text, code)`` among the sorted pairs ``(owner, listed)``, -1 where absent."""
    both_owner, both_code = np.concatenate([owner, text]), np.concatenate([listed, codes])
    asked = np.concatenate([np.zeros(len(owner), np.int8), np.ones(len(text), np.int8)])
    order = np.lexsort((asked, both_code, both_owner))
    source = np.where(asked[order] == 0, np.arange(len(order)), -1)
    source = np.maximum.accumulate(source) if len(order) else source
    result = np.full(len(text), -1)
    at = order[source]
    hit = (asked[order] == 1) & (source >= 0)
    hit &= (both_owner[order] == both_owner[at]) & (both_code[order] == both_code[at])
    result[order[hit] - len(owner)] = at[hit]
    return result


def _whole_groups(batches: Iterator[pa.RecordBatch], key: str, limit: int) -> Iterator[pa.Table]:
    """Consecutive rows as tables of about ``limit`` bytes or more that never split a key; sorted by it."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, 4_096)
            if size >= limit:
                keys = part.column(key).to_numpy()
                last = held[-1].column(key)[-1].as_py()
                same = int(np.searchsorted(keys != last, True)) if keys[-1] != last else len(keys)
                if same < len(keys):
                    if same:
                        held.append(part.slice(0, same))
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
                    part = part.slice(same)
            held.append(part)
            size += part.nbytes
            start += 4_096
    if held:
        yield pa.Table.from_batches(held)


class SuffixTrees:
    """Suffix trees of some texts' words, as the order of all suffixes and what neighbours share.

    ``order`` lists suffixes by their words, ``shared`` the words that each has
    in common with the one before it, ``depth`` the depth of the internal node
    above each suffix.  A suffix is numbered by its place when all texts stand
    one after the other, ``first`` holding the place of each text's first word;
    a separator of its own ends each text, so no suffix runs on.
    """

    def __init__(self, texts: pa.Array) -> None:
        words = Words(texts)
        length = words.counts + 1
        total = int(length.sum())
        self.first = np.cumsum(length) - length
        _, word_rank = np.unique(words.codes(), return_inverse=True)
        rank = np.empty(total, dtype=np.int64)
        rank[ranges(self.first, words.counts)] = word_rank + len(texts)
        rank[self.first + words.counts] = np.arange(len(texts))
        # ranks[k] tells apart the first 2**k words; place ``total`` is beyond the last separator
        ranks, n_ranks = [], 0
        while n_ranks < total:
            ranks.append(np.append(rank, -1).astype(np.int32))
            step = 1 << (len(ranks) - 1)
            following = np.zeros(total, dtype=np.int64)
            following[: total - step] = rank[step:] + 1
            values, rank = np.unique(rank * (total + 1) + following, return_inverse=True)
            n_ranks = len(values)
        self.order = np.empty(total, dtype=np.int64)
        self.order[rank] = np.arange(total)
        before, after = self.order[:-1], self.order[1:]
        common = np.zeros(len(before), dtype=np.int64)
        for k in reversed(range(len(ranks))):
            same = ranks[k][np.minimum(before + common, total)] == ranks[k][np.minimum(after + common, total)]
            common += same.astype(np.int64) << k
        self.shared = np.concatenate([np.zeros(min(1, total), np.int64), common])
        self.depth = np.empty(total, dtype=np.int64)
        self.depth[self.order] = np.maximum(self.shared, np.append(self.shared[1:], 0)[:total])

    def internal_nodes(self, least: int) -> Iterator[tuple[int, np.ndarray]]:
        """Nodes of ``least`` words or more: their depth and the suffixes below, each right-maximal."""
        stack: list[tuple[int, int]] = []
        for at, common in enumerate([*self.shared[1:].tolist(), 0], 1):
            begin = at - 1
            while stack and stack[-1][0] > common:
                depth, begin = stack.pop()
                yield depth, self.order[begin:at]
            if common >= least and (not stack or stack[-1][0] < common):
                stack.append((common, begin))

    def maximal_ranges(self, n_starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word and length of the repeats of ``least`` words or more that begin at the first ``n_starts`` words of each text.

        A repeat that lies inside the one beginning a word before is left out.
        """
        text = np.repeat(np.arange(len(n_starts)), n_starts)
        start = ranges(np.zeros(len(n_starts), np.int64), n_starts)
        depth = self.depth[ranges(self.first, n_starts)]
        end = start + depth
        maximal = depth >= least
        maximal[1:] &= (text[1:] != text[:-1]) | (end[1:] > end[:-1])
        return text[maximal], start[maximal], depth[maximal]


def _build_trees(window: int):
    """Step 4: ranges ``(h1, h2, start, n)`` of ``n`` windows that repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, "prefix", 6 * BUILD_WORDS):
            kinds = table.column("kind").to_numpy()
            numbers = {n: table.column(n).to_numpy() for n in ("prefix", "h1", "h2", "start", "n")}
            for kind in np.unique(kinds).tolist():
                at = np.flatnonzero(kinds == kind)
                h1, h2, start, n = (numbers[c][at] for c in ("h1", "h2", "start", "n"))
                if kind == _RUN:
                    texts = table.column("text").take(pa.array(at)).cast(pa.large_binary()).combine_chunks()
                    texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
                    row, place, depth = SuffixTrees(texts).maximal_ranges(n, window)
                    h1, h2, start, n = h1[row], h2[row], start[row] + place, depth - window + 1
                elif kind == _WINDOW:
                    second = np.array([int.from_bytes(x, "little") for x in table.column("text").take(pa.array(at)).to_pylist()], dtype=np.uint64)
                    _, pair = np.unique(np.stack([numbers["prefix"][at].view(np.uint64), second]), axis=1, return_inverse=True)
                    pair = pair.reshape(-1)
                    repeated = np.bincount(pair)[pair] > 1
                    h1, h2, start, n = (c[repeated] for c in (h1, h2, start, n))
                if len(n):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (h1, h2, start, n)], names=["h1", "h2", "start", "n"])

    return run


def _drop_words(window: int):
    """Step 5: what is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            out = []
            for doc_id, text, found in zip(*(batch.column(c) for c in ("doc_id", "text", "found")), strict=True):
                words = text.as_buffer().to_pybytes().split()  # of bytes: exactly the white space of a word here
                n_words, spans = len(words), _spans(found.as_py() or [], window)
                for start, end in reversed(spans):
                    del words[start:end]
                kept = b" ".join(words)
                removed = [{"start": s, "end": e} for s, e in spans]
                out.append((doc_id.as_py(), n_words, n_words - len(words), hashlib.sha256(kept).hexdigest(), kept.decode(), removed))
            yield _batch(out, _RESULT_TYPES, _RESULT_NAMES)

    return run


_RESULT_NAMES = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "removed"]
_RESULT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, removed array<struct<start:bigint,end:bigint>>"


def _spans(found: list[dict], window: int) -> list[tuple[int, int]]:
    """Words covered by ranges of windows, as disjoint spans in order."""
    spans: list[list[int]] = []
    for start, n in sorted((f["start"], f["n"]) for f in found):
        end = start + n + window - 1
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return [(s, e) for s, e in spans]


#: Spark's setting that shuffle files go when the query that wrote them ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared scratch folder; the shuffle files behind them go with the write."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.parquet(path)


def _repeated_prefixes(rows: DataFrame, window: int, prefix: int, group_limit: int) -> tuple[DataFrame, int]:
    """Step 2: ``(prefix, h1, frequent)`` for the prefixes of each text that repeat, and how many lengths were counted."""
    alive, frequent = None, []
    while True:
        prefixes = rows.select("h1", "text").mapInArrow(_count_prefixes(window, prefix, frequent), "prefix long, h1 long, n long")
        prefixes = _stored(prefixes, "prefixes")
        repeated = prefixes.groupBy("prefix").agg(F.sum("n").alias("n")).filter("n > 1")
        repeated = _stored(repeated.select("prefix", (F.col("n") > group_limit).alias("frequent")), "repeated-prefixes")
        found = salted_join(prefixes.select("prefix", "h1"), repeated, "prefix", F.col("h1"), "inner", 4)
        alive = found if alive is None else alive.unionByName(found)
        too_frequent = repeated.filter("frequent").select("prefix")
        n_lengths = len(frequent) + 1
        if n_lengths == len(_lengths(window, prefix)) or not 0 < too_frequent.count() <= FREQUENT_LIMIT:
            return alive, n_lengths
        frequent.append(np.sort(np.array([r[0] for r in too_frequent.collect()], dtype=np.int64).view(np.uint64)))


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    doc_id: str = "doc_id",
    prefix: int = PREFIX,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256, kept_text, removed``.

    ``removed`` are the disjoint spans of word numbers that the repeats cover.
    """
    if window < 1:
        raise ValueError("a window has at least one word")
    prefix = min(prefix, window)
    spark = docs.sparkSession
    content = text_or_empty(text)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(content).alias("h1"),
        F.xxhash64(F.lit("second"), content).alias("h2"),
        content.cast("binary").alias("text"),
    )
    alive, n_lengths = _repeated_prefixes(rows, window, prefix, group_limit)
    lists = alive.groupBy("h1").agg(F.collect_set(F.struct("prefix", "frequent")).alias("prefixes"))
    dealt = salted_join(rows, lists, "h1", F.xxhash64("doc_id"), "inner", 4)
    runs = dealt.select("h1", "h2", "text", "prefixes").mapInArrow(_deal_runs(window, prefix, n_lengths), _SCHEMA)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grouped = runs.repartition(tasks, "prefix").sortWithinPartitions("prefix")
    found = grouped.mapInArrow(_build_trees(window), "h1 long, h2 long, start long, n long")
    spans = found.groupBy("h1", "h2").agg(F.collect_set(F.struct("start", "n")).alias("found"))
    spans = _stored(spans.select(F.struct("h1", "h2").alias("key"), "found"), "repeats")
    keyed = rows.select("doc_id", "text", F.struct("h1", "h2").alias("key"))
    joined = salted_join(keyed, spans, "key", F.xxhash64("doc_id"), "left", 4)
    return joined.select("doc_id", "text", "found").mapInArrow(_drop_words(window), _RESULT)


def repeat_report(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERY_SQL = r"""
  WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT r, unnest(range(1, len(w) - 33)) AS i FROM d),
  x AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS t FROM s JOIN d USING (r)),
  f AS (SELECT r, i FROM x QUALIFY count(*) OVER (PARTITION BY t) > 1),
  g AS (SELECT r, list(i) AS f FROM f GROUP BY r),
  c AS (SELECT r, doc_id, w, CASE WHEN f IS NULL THEN []::BIGINT[] ELSE
    list_distinct(flatten(list_transform(f, lambda i: range(i, i + 35)))) END AS c FROM d LEFT JOIN g USING (r)),
  k AS (SELECT doc_id, len(w)::BIGINT AS n_words, len(c)::BIGINT AS n_removed, w, c, r FROM c),
  u AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM k),
  v AS (SELECT r, unnest(c) AS i FROM k),
  y AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM u ANTI JOIN v USING (r, i) GROUP BY r)
  SELECT doc_id, n_words, n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM k LEFT JOIN y USING (r)
"""
