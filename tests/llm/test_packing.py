from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from helpers import odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from leaguelake.llm import packing
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def layout(counts: np.ndarray, capacity: int) -> dict[int, list[tuple[int, int]]]:
    """Sequences as (offset, length) by following the plan for every piece."""
    places = packing.plan(counts, capacity)
    keys = places["length"] * (1 << 40) + places["first"]
    out: dict[int, list[tuple[int, int]]] = {}
    for length in np.flatnonzero(counts):
        for number in range(counts[length]):
            at = np.searchsorted(keys, length * (1 << 40) + number, "right") - 1
            sequence = int(places["sequence"][at] + number - places["first"][at])
            out.setdefault(sequence, []).append((int(places["offset"][at]), int(length)))
    return out


def check(out: dict[int, list[tuple[int, int]]], capacity: int) -> None:
    for places in out.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


@settings(max_examples=200, deadline=None)
@given(st.integers(4, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=60))))
def test_every_piece_has_its_own_place_and_no_sequence_overflows(case):
    capacity, lengths = case
    counts = np.bincount(np.array(lengths, np.int64), minlength=capacity + 1)
    out = layout(counts, capacity)
    assert sorted(n for places in out.values() for _, n in places) == sorted(lengths)
    check(out, capacity)


def test_complements_fill_exactly():
    counts = np.zeros(101, np.int64)
    counts[[100, 60, 40, 50, 30, 20, 70, 15, 10, 5]] = [3, 8, 8, 10, 6, 6, 4, 2, 2, 2]
    out = layout(counts, 100)
    total = int((counts * np.arange(101)).sum())
    assert len(out) == -(-total // 100)
    check(out, 100)


def test_is_close_to_the_bound():
    rng = np.random.default_rng(2)
    lengths = np.clip(rng.lognormal(6, 1, 20000), 1, 2048).astype(int)
    counts = np.bincount(lengths, minlength=2049)
    places = packing.plan(counts)
    check(layout(counts, 2048), 2048)
    used = len(layout(counts, 2048))
    assert used <= 1.002 * lengths.sum() / 2048 + 1
    assert len(places["length"]) <= 8 * 2048


def test_one_length_for_most_rows():
    counts = np.zeros(2049, np.int64)
    counts[700], counts[648], counts[3] = 900, 1, 50
    out = layout(counts, 2048)
    check(out, 2048)
    assert len(out) == 450


def test_piece_bounds():
    assert packing.piece_bounds(1, 8) == [0, 1]
    assert packing.piece_bounds(8, 8) == [0, 8]
    assert packing.piece_bounds(9, 8) == [0, 1, 9]
    assert packing.piece_bounds(24, 8) == [0, 8, 16, 24]


def test_odd_rows(spark):
    library = Tokenizer.from_file(PATH)
    docs = odd_documents(spark)
    found = packing.packed(docs, PATH).collect()
    expected = []
    for row in docs.collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, packing.END]
        bounds = packing.piece_bounds(len(ids), 2048)
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            expected.append((row.doc_id, piece, a, b - a, crc))
    assert sorted(str(tuple(r)[:5]) for r in found) == sorted(map(str, expected))
    out: dict[int, list[tuple[int, int]]] = {}
    for r in found:
        out.setdefault(r.sequence_id, []).append((r.offset, r.length))
    check(out, 2048)


def test_empty(spark):
    assert packing.packed(odd_documents(spark, []), PATH).count() == 0
