"""Vectorised words of whole Arrow batches: places, 64-bit codes and shingles.

A word is a run of bytes other than space and tab to carriage return, so UTF-8
text needs no decoding.  Codes are polynomial hashes with fixed random tables,
the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20240)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes hashed at a time; longer words are taken whole.
_STEP = 1 << 20
_powers: list[np.ndarray] = []


def mix(codes: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    codes = (codes ^ (codes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    codes = (codes ^ (codes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return codes ^ (codes >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        size = max(n, _STEP) + 1
        pair = []
        for base in (_BASE, _INVERSE):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            pair.append(np.cumprod(factors, dtype=np.uint64))
        _powers[:] = pair
    return _powers[0], _powers[1]


class Words:
    """Words of consecutive texts.

    ``data`` are the texts' bytes, ``starts`` and ``ends`` the byte ranges of
    the words, ``first`` the number of the first word of each text, with the
    total at the end.
    """

    def __init__(self, texts: pa.Array, lower: bool = False) -> None:
        texts = texts.cast(pa.large_binary()) if len(texts) else pa.array([], pa.large_binary())
        if texts.null_count:
            texts = texts.fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        values = texts.buffers()[2] if len(texts) else None
        data = np.frombuffer(values, dtype=np.uint8)[offsets[0] : offsets[-1]] if values is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.data = _LOWER[data] if lower else data
        letter = ~_IS_SPACE[data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[self.offsets] = True
        before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
        before[1:], after[:-1] = letter[:-1], letter[1:]
        self.starts = np.flatnonzero(letter & (~before | cut[:-1]))
        self.ends = np.flatnonzero(letter & (~after | cut[1:])) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def codes(self) -> np.ndarray:
        """A 64-bit code per word."""
        codes = np.empty(len(self), dtype=np.uint64)
        done = 0
        while done < len(self):
            begin = self.starts[done]
            until = max(done + 1, int(np.searchsorted(self.ends, begin + _STEP, "right")))
            end = int(self.ends[until - 1])
            powers, inverse = _powers_to(end - begin)
            sums = np.zeros(end - begin + 1, dtype=np.uint64)
            np.cumsum(_BYTE[self.data[begin:end]] * powers[: end - begin], out=sums[1:])
            a, b = self.starts[done:until] - begin, self.ends[done:until] - begin
            codes[done:until] = (sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)
            done = until
        return mix(codes)

    def texts(self) -> np.ndarray:
        """Number of the text that holds each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def shingles(codes: np.ndarray, k: int) -> np.ndarray:
    """Code of ``k`` consecutive words, for every place where they fit; texts are not told apart."""
    if len(codes) < k:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(codes) - k + 1, dtype=np.uint64)
    for j in range(k):
        total += codes[j : len(codes) - k + 1 + j] * _PLACE[j % 64] + np.uint64(j // 64)
    return mix(total)


def windows(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent codes of ``k`` consecutive words for every place where they fit, by running sums."""
    powers, inverse = _powers_to(len(codes) + 1)
    result = []
    for values in (codes, mix(codes ^ _PLACE[0])):
        sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(values * powers[: len(codes)], out=sums[1:])
        n = max(0, len(codes) - k + 1)
        result.append(mix((sums[k : k + n] - sums[:n]) * inverse[:n]))
    return result[0], result[1]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and where each text's begin (with the total at the end).

    A text of fewer words has its whole sequence as one shingle, one without words none.
    """
    codes, first, counts = words.codes(), words.first, words.counts
    n_texts = len(counts)
    windows = np.maximum(counts - k + 1, 0)
    text = np.repeat(np.arange(n_texts), windows)
    place = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(first[:-1], windows)
    full = shingles(codes, k)[place] if len(text) else np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    short_codes = np.array([shingles(codes[first[i] : first[i + 1]], int(counts[i]))[0] + np.uint64(counts[i]) for i in short], dtype=np.uint64)
    text = np.concatenate([text, short])
    values = np.concatenate([full, short_codes])
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    text, values = text[new], values[new]
    return values, np.searchsorted(text, np.arange(n_texts + 1))


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column).cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end
