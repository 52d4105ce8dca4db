from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from helpers import odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from leaguelake.llm import bpe
from leaguelake.llm.vocabulary import vocabulary
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["<|endoftext|>", "'s", "  ", " \n", "\t", "the ", "ing", "é", "ñ", "日本", "😀", "3", "12", "_", "　", "\x0b", "A", "b"]


@pytest.fixture(scope="module")
def library() -> Tokenizer:
    return Tokenizer.from_file(PATH)


def ids(text: str) -> list[int]:
    return np.frombuffer(bpe.text_encoder(PATH).encode(text), "<u4").tolist()


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=6)), max_size=20).map("".join))
def test_equals_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    library = Tokenizer.from_file(PATH) if not hasattr(test_equals_the_library, "t") else test_equals_the_library.t
    test_equals_the_library.t = library
    expected = library.encode(text, add_special_tokens=False).ids
    assert ids(text) == expected
    assert bpe.decode(np.array(expected, "<u4"), PATH) == library.decode(expected, skip_special_tokens=False)


def test_decodes_broken_utf8_as_the_library(library):
    one = [i for i, t in enumerate(vocabulary(PATH).tokens) if t == b"\xc3"][0]
    assert bpe.decode(np.array([one, 64], "<u4"), PATH) == library.decode([one, 64], skip_special_tokens=False)


def test_long_runs_are_exact(library):
    for text in ("ab" * 5000, "a" * 7000, "the" * 3000, " " * 3000, "=" * 4001):
        assert ids(text) == library.encode(text, add_special_tokens=False).ids


def test_odd_rows_round_trip(spark, library):
    docs = odd_documents(spark)
    found = bpe.round_trip(docs, PATH).collect()
    expected = []
    for row in docs.collect():
        wanted = library.encode(row.text or "", add_special_tokens=False).ids
        expected.append((
            row.doc_id, len(wanted), hashlib.sha256(np.array(wanted, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((row.text or "").encode()).hexdigest(),
        ))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    back = bpe.decoded(bpe.encoded(docs, PATH), PATH).collect()
    assert sorted(str((r.id, r.text)) for r in back) == sorted(str((r.doc_id, r.text or "")) for r in docs.collect())


def test_empty(spark):
    assert bpe.round_trip(odd_documents(spark, []), PATH).count() == 0
