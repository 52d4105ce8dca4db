"""Byte-pair encoding by backtracking, and decoding by an offset table.

Encoder. An Aho-Corasick automaton over all tokens finds, in one pass, the longest token that begins
at every byte. The encoder walks left to right taking the longest token that is compatible with the
one before it; where none is, it tries the token's next shorter prefix that is a token, and where
these run out it steps back over the last token and marks the place as dead. Two adjacent tokens are
compatible if the merges, applied in order, would leave exactly this border between them; the answers
are kept in a table of pairs. A sequence of pairwise compatible tokens is the exact result of the
merges, and no place dies twice, so the time is linear.

Decoder. All token bytes lie in one array; an offset table says where each token begins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.common import in_tasks
from leaguelake.llm.vocabulary import TextEncoder, Vocabulary, vocabulary

#: Answers that the pair table holds before it starts anew.
PAIR_ANSWERS = 1 << 20


class BacktrackingEncoder:
    def __init__(self, words: Vocabulary) -> None:
        import ahocorasick

        self.words = words
        self.automaton = ahocorasick.Automaton()
        for token, i in words.ids.items():
            self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self.length = [len(t) for t in words.tokens]
        self.shorter: dict[int, int | None] = {}
        self.compatible: dict[tuple[int, int], bool] = {}

    def _shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if token not in self.shorter:
            text, ids = self.words.tokens[token], self.words.ids
            found = (ids[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in ids)
            self.shorter[token] = next(found, None)
        return self.shorter[token]

    def _border_stands(self, left: int, right: int) -> bool:
        """True if no merge crosses the border while the two tokens are being built.

        Undo the merges of both, the latest first: after each step the tokens that touch at the
        border existed together, until the next of the undone merges. If they could have been merged
        before that, they would have been.
        """
        parts, made = self.words.parts, self.words.made
        horizon = len(self.words.tokens)
        while True:
            if made.get((left, right), horizon) < horizon:
                return False
            left_made, right_made = parts.get(left), parts.get(right)
            if left_made is None and right_made is None:
                return True
            # Of equal merges the left one happens first, so the right one is undone first.
            if right_made is None or (left_made is not None and left > right):
                horizon, left = left, left_made[1]
            else:
                horizon, right = right + 1, right_made[0]

    def _fits(self, left: int, right: int) -> bool:
        pair = (left, right)
        answer = self.compatible.get(pair)
        if answer is None:
            if len(self.compatible) >= PAIR_ANSWERS:
                self.compatible.clear()
            answer = self.compatible[pair] = self._border_stands(left, right)
        return answer

    def encode(self, piece: bytes) -> list[int]:
        longest: list[int | None] = [None] * len(piece)
        for end, (token, n) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - n + 1] = token  # later matches from the same place are longer
        alive = [True] * (len(piece) + 1)
        out: list[int] = []
        place, token = 0, longest[0] if piece else None
        while place < len(piece):
            while token is not None:
                end = place + self.length[token]
                if alive[end] and (not out or self._fits(out[-1], token)):
                    break
                token = self._shorter(token)
            if token is None:
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                alive[place] = False
                token = out.pop()
                place -= self.length[token]
                token = self._shorter(token)
            else:
                out.append(token)
                place = end
                token = longest[place] if place < len(piece) else None
        return out


@cache
def text_encoder(path: str) -> TextEncoder:
    words = vocabulary(path)
    return TextEncoder(words, BacktrackingEncoder(words).encode)


@cache
def _offsets(path: str) -> tuple[np.ndarray, np.ndarray]:
    return vocabulary(path).offset_table()


def decode(ids: np.ndarray, path: str) -> str:
    """The text of the ids: token bytes copied by their offsets, then read as UTF-8."""
    flat, offsets = _offsets(path)
    starts = offsets[ids]
    sizes = offsets[ids.astype(np.int64) + 1] - starts
    ends = np.cumsum(sizes)
    if not len(ids) or not ends[-1]:
        return ""
    where = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
    return flat[where].tobytes().decode("utf-8", "replace")


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encode = text_encoder(path).encode
    for batch in batches:
        ids = [encode(text.as_py() or "") for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(ids, pa.binary())], ["id", "ids"]
        )


def _round_trips(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encode = text_encoder(path).encode
    for batch in batches:
        counts, of_ids, of_text = [], [], []
        for text in batch.column("text"):
            raw = encode(text.as_py() or "")
            ids = np.frombuffer(raw, "<u4")
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(raw).hexdigest())
            of_text.append(hashlib.sha256(decode(ids, path).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
            ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def _pick(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows, dict(rows.dtypes)["id"]


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids (binary, little-endian unsigned 32 bits) of every text.

    Null and empty texts have no ids. Rows are independent: null or repeated ids and other columns, whatever
    their names, do not matter. Lone surrogates, which UTF-8 cannot hold, read as question marks.
    """
    rows, kind = _pick(docs, id_col, text_col)
    return in_tasks(rows, partial(_encoded, path=path), f"id {kind}, ids binary")


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [decode(np.frombuffer(raw.as_py() or b"", "<u4"), path) for raw in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])


def decoded(rows: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """id and text of rows as `encoded` makes them. Null ids read as no ids, an empty text."""
    picked = rows.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return in_tasks(picked, partial(_decoded, path=path), f"id {dict(picked.dtypes)['id']}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes in one pass: id, n_tokens, and SHA-256 of the ids and of the decoded text."""
    rows, kind = _pick(docs, id_col, text_col)
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return in_tasks(rows, partial(_round_trips, path=path), schema)
