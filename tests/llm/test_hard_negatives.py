"""Hard negatives against plain sorting of all scores."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from leaguelake.llm import hard_negatives
from leaguelake.llm.queries import QUERIES
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, id string, x string, score string, rank string"


def _rows(spark, rows):
    return spark.createDataFrame([(*r, "u", "i", "x", "s", "r") for r in rows], SCHEMA)


def _mined(spark, rows, every=100, parts=4):
    df = _rows(spark, rows).repartition(parts)
    vectors = hard_negatives.vectors(df, "vec_id", "embedding", F.col("label"))
    found = hard_negatives.mined(vectors, F.col("id") % every == 0).collect()
    return Counter(map(tuple, found))


def _by_sorting(rows, every=100):
    whole = [
        (i, [math.floor(256 * float(np.float32(c))) for c in v], label) for i, v, label in rows
        if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    found = []
    for at, (anchor, x, label) in enumerate(whole):
        if anchor % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(x, y, strict=True)), i, other == label)
            for j, (i, y, other) in enumerate(whole) if j != at
        )
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            window = [(s, i) for s, i, alike in scored if not alike and 80 * -p <= 100 * -s <= 100 * -p][:5]
            found += [(anchor, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(window, 1)]
    return Counter(found)


def _random(n, seed, d=6, labels=3, levels=None):
    random = np.random.default_rng(seed)
    vectors = random.random((n, d)) if levels is None else random.integers(0, levels, (n, d)) / 4
    return [(i, v, int(label)) for i, (v, label) in enumerate(zip(vectors.tolist(), random.integers(0, labels, n), strict=True))]


@pytest.mark.parametrize("rows", [_random(400, 1), _random(300, 2, levels=3), _random(300, 3, d=1, levels=2)])
def test_equals_sorting(spark, rows):
    found = _mined(spark, rows, every=10)
    assert found == _by_sorting(rows, every=10) and len(found) > 100


def test_scores_below_zero(spark):
    random = np.random.default_rng(7)
    rows = [(i, v, i % 2) for i, v in enumerate((random.random((120, 2)) - 0.5).tolist())]
    assert _mined(spark, rows, every=5) == _by_sorting(rows, every=5)


def test_rounds_give_what_one_round_gives(spark, monkeypatch):
    rows = _random(300, 4)
    monkeypatch.setattr(hard_negatives, "ROUND_ENTRIES", 64)
    monkeypatch.setattr(hard_negatives, "BLOCK_SCORES", 50)
    assert _mined(spark, rows, every=10) == _by_sorting(rows, every=10)


def test_ties_and_repeated_rows(spark):
    rows = [(i, [1.0, 0.5], i % 3) for i in range(40, 0, -1)] + [(0, [1.0, 0.5], 0)] * 3 + [(7, [1.0, 0.5], 1)] * 8
    found = _mined(spark, rows, every=20)
    assert found == _by_sorting(rows, every=20)
    assert max(found.values()) > 1  # copies are rows of their own


def test_rows_that_take_no_part(spark):
    rows = _random(60, 5, d=2)
    bad = [
        (100, None, 1), (200, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (300, [1.0, None], 1),
        (400, [float("nan"), 1.0], 1), (500, [float("inf"), 1.0], 0),
    ]
    found = _mined(spark, rows + bad, every=10)
    assert found == _by_sorting(rows, every=10)


def test_without_anchors_positives_or_rows(spark):
    assert not _mined(spark, [])
    assert not _mined(spark, [(1, [1.0], 0), (2, [1.0], 1)])
    assert not _mined(spark, [(100, [1.0], 0), (2, [1.0], 1)])  # no other row of its label
    assert not _mined(spark, [(100, [1.0], 0), (2, [1.0], 0)])  # no other label
    assert not _mined(spark, [(100, [], 0), (2, [], 0)])


def test_lengths_must_agree(spark):
    with pytest.raises(Exception, match="different lengths"):
        _mined(spark, [(100, [1.0, 2.0], 0), (2, [1.0], 1)])


def test_query_moves_labels_on(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert Counter(map(tuple, QUERIES["op13_hard_negatives"](spark, folder).collect())) == _by_sorting(rows)
