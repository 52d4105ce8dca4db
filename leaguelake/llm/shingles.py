"""Hashes of words and word shingles, vectorised over the bytes of one text."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at a time, so that a very long text needs no more memory than a short one.
BLOCK = 1 << 18
_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[np.frombuffer(b" \t\n\v\f\r", np.uint8)] = 0
_SPACE = _BYTE == 0
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(0, _U), np.ones(0, _U))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits (the finaliser of a well-known public-domain hash)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        def table(base: int) -> np.ndarray:
            steps = np.full(max(n, 1 << 14), base, np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)

        _powers = table(_BASE), table(_INVERSE)
    return _powers


def _block_hashes(raw: np.ndarray) -> np.ndarray:
    n = len(raw)
    up, down = _power_tables(n + 1)
    edges = np.flatnonzero(np.diff(_SPACE[raw], prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash for each run of bytes other than ASCII white space, A-Z lower-cased."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    if len(raw) <= BLOCK:
        return _block_hashes(raw)
    found, start = [], 0
    while start < len(raw):
        end = min(start + BLOCK, len(raw))
        while end < len(raw) and not _SPACE[raw[end]]:
            gap = np.flatnonzero(_SPACE[raw[end : end + BLOCK]])
            end = end + int(gap[0]) if len(gap) else min(end + BLOCK, len(raw))
        found.append(_block_hashes(raw[start:end]))
        start = end
    return np.concatenate(found)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of `width` words in a row; of all words if there are fewer."""
    n = min(width, len(words))
    if n == 0:
        return np.empty(0, np.uint64)
    multipliers = mix(np.arange(1, n + 1, dtype=np.uint64) * _U(_BASE)) | _U(1)
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total += words[i : len(words) - n + 1 + i] * multipliers[i]
    return np.unique(mix(total))
