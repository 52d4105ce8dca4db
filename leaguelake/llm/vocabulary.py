"""Byte-pair vocabularies read from a public tokenizer file, and a cached encoder for whole texts."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import cache

import numpy as np

#: Fixed value: the published split pattern of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces and parts that an encoder remembers, the bound of its memory (some 200 MB).
CACHE_PIECES = 700_000
CACHE_PARTS = 400_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in such files, by its published rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens as bytes by id, the merge that makes each, and the special strings."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        alphabet = byte_alphabet()
        unprintable = lambda s: bytes(map(alphabet.__getitem__, s))
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        ids = {unprintable(s): i for s, i in described["model"]["vocab"].items() if s not in self.special}
        self.ids = ids
        size = 1 + max([*ids.values(), *self.special.values()])
        self.tokens: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.tokens[i] = token
        for text, i in self.special.items():
            self.tokens[i] = text.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        #: parts of each merged token, and the token that a pair makes
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[tuple[int, int], int] = {}
        previous = -1
        for left, right in merges:
            a, b = unprintable(left), unprintable(right)
            token = ids[a + b]
            if token <= previous:
                raise ValueError("the ids of merged tokens do not follow the order of the merges")
            previous = token
            self.parts[token] = self.made_from(a, b)
            self.made[self.parts[token]] = token

    def made_from(self, left: bytes, right: bytes) -> tuple[int, int]:
        return self.ids[left], self.ids[right]

    def offset_table(self) -> tuple[np.ndarray, np.ndarray]:
        """All token bytes in a row and where each token begins, with the end at last."""
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.tokens])])
        return np.frombuffer(b"".join(self.tokens), np.uint8), offsets.astype(np.int64)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class TextEncoder:
    """Encodes whole texts to little-endian 32-bit ids, remembering the ids of words it has met.

    A new piece begins at every blank that a non-space follows, so a text is cut there and each
    part encoded once. Texts in which another white space follows a blank are split by the pattern as a
    whole. Special strings become their ids first, as the reference library does by default.
    """

    def __init__(self, words: Vocabulary, encode_piece: Callable[[bytes], list[int]]) -> None:
        import regex

        self.split = regex.compile(SPLIT).findall
        self.irregular = re.compile(r" (?!\S)").search
        special = "|".join(map(re.escape, sorted(words.special, key=len, reverse=True)))
        self.special_ids = words.special
        self.specials = re.compile(f"({special})") if special else None
        self.encode_piece = encode_piece
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _by_pattern(self, text: str) -> bytes:
        pieces = self.pieces
        if len(pieces) > CACHE_PIECES:
            pieces.clear()
        out = []
        for piece in self.split(text):
            if (found := pieces.get(piece)) is None:
                ids = self.encode_piece(piece.encode("utf-8", "replace"))
                found = np.array(ids, "<u4").tobytes()
                if len(piece) <= 64:
                    pieces[piece] = found
            out.append(found)
        return b"".join(out)

    def _ordinary(self, text: str) -> bytes:
        if not text:
            return b""
        if self.irregular(text):
            return self._by_pattern(text)
        parts = self.parts
        if len(parts) > CACHE_PARTS:
            parts.clear()
        # A plain blank opens every part but the first; the key of a first part says so.
        cut = text.split(" ")
        first = self._by_pattern(cut[0]) if cut[0] else b""
        try:
            return first + b"".join(map(parts.__getitem__, cut[1:]))
        except KeyError:
            out = [first]
            for part in cut[1:]:
                if (found := parts.get(part)) is None:
                    found = self._by_pattern(" " + part)
                    if len(part) <= 64:
                        parts[part] = found
                out.append(found)
            return b"".join(out)

    def encode(self, text: str) -> bytes:
        if self.specials is None or not any(s in text for s in self.special_ids):
            return self._ordinary(text)
        out = []
        for part in self.specials.split(text):
            if part in self.special_ids:
                out.append(np.array([self.special_ids[part]], "<u4").tobytes())
            else:
                out.append(self._ordinary(part))
        return b"".join(out)
