"""Small documents with every edge case, and plain Python versions of the operators."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns of ``documents`` and some with names that the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, digest string, node string, size string, _salt int, ids string, key string"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def row(doc_id, text, source="a"):
    n = None if text is None else len(text)
    return (doc_id, text, "en", source, n, 7, "d", "n", "s", 3, "i", "k")


def prose(seed: int, n: int) -> str:
    """``n`` words that hardly repeat."""
    value, out = seed * 7919 + 1, []
    for _ in range(n):
        value = (value * 1103515245 + 12345) % 2**31
        out.append("w" + format(value, "x"))
    return " ".join(out)


def documents() -> list[tuple]:
    base = prose(1, 120)
    near = base.replace(base.split()[3], "other")
    passage = prose(9, 60)
    return [
        row(1, base),
        row(2, base),
        row(3, near, "b"),
        row(4, None, None),
        row(5, "", "b"),
        row(6, " \t\n ", "b"),
        row(7, "one two", "c"),
        row(8, "One TWO", None),
        row(9, prose(2, 80) + "\n" + passage + "\n" + prose(3, 70), "c"),
        row(10, passage + " " + prose(4, 90), "c"),
        row(11, "again and again " * 60, "a"),
        row(12, "line of some words\n" * 30, "a"),
        row(13, " ".join(w + "***" for w in prose(5, 90).split()), "b"),
        row(None, prose(6, 100), "a"),
        row(None, None, "a"),
        row(14, prose(7, 130), "a"),
        row(14, prose(7, 130), "a"),
        row(14, prose(8, 130), "a"),
        row(15, prose(10, 40_000), "b"),
        row(16, prose(11, 200) + " éü中 \x1c \x85 z", "c"),
    ]


def components(ids: list, linked) -> dict[int, int]:
    """Index to smallest index reachable."""
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingle_set(text: str | None, k: int) -> frozenset:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lowered)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def linked_pairs(texts: list[str | None], k: int, percent: int) -> list[tuple[int, int]]:
    sets = [shingle_set(t, k) for t in texts]
    return [
        (i, j)
        for i in range(len(sets))
        for j in range(i + 1, len(sets))
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]


def kept_words(texts: list[str | None], window: int) -> list[list[str]]:
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        covered = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append([x for j, x in enumerate(w) if j not in covered])
    return out


def measures(text: str | None) -> dict[str, int]:
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if words(line)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def failed_rules(text: str | None) -> list[str]:
    m = measures(text)
    tests = {
        "too_few_words": m["n_words"] < 50,
        "repeated_words": 100 * m["n_repeat_words"] > 50 * m["n_words"],
        "symbols": 10 * m["n_symbols"] > m["n_words"],
        "repeated_lines": 2 * m["n_dup_lines"] > m["n_lines"],
        "short_words": m["word_chars"] < 2 * m["n_words"],
        "long_words": m["word_chars"] > 15 * m["n_words"],
    }
    return [rule for rule, failed in tests.items() if failed]
