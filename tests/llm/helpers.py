"""Brute-force counterparts and odd inputs shared by these tests."""

from __future__ import annotations

import re

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: doc_id, text, and columns whose names operators use inside.
ODD_SCHEMA = "doc_id long, text string, id string, node int, row_key string, score string, n long, digest int"
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, "one two"), (5, "one two"), (None, "one two"),
    (None, None), (7, "ONE Two"), (8, "12 34 !?"), (9, "É é ñ 日本 😀 <|endoftext|>"),
    (10, "Long word " * 3000), (11, "x" * 300_000), (12, "alpha beta gamma delta epsilon zeta"),
]


def odd_documents(spark, rows=None):
    rows = ODD if rows is None else rows
    return spark.createDataFrame([(*row, "i", 1, "k", "s", 2, 3) for row in rows], ODD_SCHEMA)


def az_lower(text: str | None) -> str:
    return "".join(c.lower() if c in UPPER else c for c in text or "")


def shingles(text: str | None) -> set[tuple[str, ...]]:
    words = re.findall("[^\x20\x09-\x0d]+", az_lower(text))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(texts: dict[int, str | None]) -> dict[int, int]:
    """Smallest id that links of at least 0.75 reach, by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders: dict[tuple[str, ...], list[int]] = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    parent = {i: i for i in sets}

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j in {j for x in s for j in holders[x] if j < i}:
            common = len(s & sets[j])
            if 100 * common >= 75 * (len(s) + len(sets[j]) - common):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in sets}
