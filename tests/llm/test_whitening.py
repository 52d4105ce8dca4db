"""Eigenvectors against a reference solver; whitening against plain numpy."""

from __future__ import annotations

import numpy as np
import pytest
from leaguelake.llm import eigen, whitening
from leaguelake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, id string, component string, n string, vector string"


def _rows(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, None, "a", "b", "c", "d") for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def _turned(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return q @ np.diag(values) @ q.T


MATRICES = {
    "random": _turned(np.random.default_rng(1).random(64)),
    "one": np.array([[3.0]]),
    "two": np.array([[2.0, 1.0], [1.0, 2.0]]),
    "identity": np.eye(20),
    "clusters": _turned([5.0] * 10 + [1.0] * 30),
    "near clusters": _turned(1 + 1e-12 * np.arange(40)),
    "wide spread": _turned([1e9, *[2.0] * 10, *[1e-7] * 10, *[0.0] * 11]),
    "split": np.kron(np.eye(2), _turned(np.arange(1.0, 17.0))),
    "zero": np.zeros((6, 6)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_eigenvectors(name):
    matrix = MATRICES[name]
    k = min(32, len(matrix))
    values, vectors = eigen.leading(matrix, k)
    scale = max(np.abs(matrix).max(), 1e-300) * len(matrix)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:k], rtol=0, atol=1e-14 * scale)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * scale


def test_tridiagonal_form():
    matrix = MATRICES["clusters"]
    diagonal, off, q = eigen.tridiagonal(matrix)
    form = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.abs(q @ form @ q.T - matrix).max() < 1e-13
    below = eigen.count_below(diagonal, off, np.array([0.0, 3.0, 9.0]))
    assert below.tolist() == [0, 30, 40]


def _by_numpy(vectors, k=32):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:k]
    values, vectors = values[order], vectors[:, order]
    return centred @ vectors / np.sqrt(values), values / np.trace(covariance), ((n * x - sums) ** 2).sum(axis=1)


def _held_against_numpy(rows, vectors, ids):
    white, explained, deviation = _by_numpy(vectors)
    k = white.shape[1]
    found = {(r.vec_id, r.component): r for r in rows}
    assert len(found) == len(rows) == len(vectors) * k
    table = np.array([[found[i, c].whitened for c in range(1, k + 1)] for i in ids])
    assert np.abs(table - white * np.sign((table * white).sum(axis=0))).max() < 1e-8
    for i, d in zip(ids, deviation, strict=True):
        assert {found[i, c].deviation for c in range(1, k + 1)} == {d}
    assert np.allclose([found[ids[0], c].explained for c in range(1, k + 1)], explained, rtol=1e-9)
    assert {r.n for r in rows} == {len(vectors)} and {type(r.n) for r in rows} == {int}


def test_query_equals_numpy(spark):
    folder = "/root/testdata/sf0.001"
    table = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect())
    rows = QUERIES["op11_embedding_whitening"](spark, folder).collect()
    assert max(r.identity_error for r in rows) < 1e-9 and len({r.identity_error for r in rows}) == 1
    _held_against_numpy(rows, [v for _, v in table], [i for i, _ in table])


def _all(rows):
    model = whitening.fit(rows)
    return model, whitening.whitened(rows, model).withColumnRenamed("id", "vec_id").collect()


def test_broken_vectors_are_left_out(spark):
    random = np.random.default_rng(2)
    good = random.standard_normal((30, 5)).tolist()
    bad = [None, [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [float("-inf")] * 5]
    rows = _rows(spark, [*bad, *good], range(-5, 30))
    model, found = _all(rows)
    _held_against_numpy(found, good, list(range(30)))
    assert whitening.identity_error(rows, model) < 1e-10


def test_repeated_rows_and_null_ids(spark):
    vectors = [[1.0, 2.0], [1.0, 2.0], [0.0, 5.0], [4.0, 1.0], [4.0, 1.0]]
    _, found = _all(_rows(spark, vectors, [1, 1, 2, None, None]))
    white, _, _ = _by_numpy(vectors)
    assert len(found) == 10 and sum(r.vec_id is None for r in found) == 4
    assert sorted(round(abs(r.whitened), 9) for r in found) == sorted(np.abs(white).round(9).ravel().tolist())


def test_tiny_spread_far_from_zero(spark):
    """Centred before multiplying: a covariance of products of the numbers themselves would drown here."""
    random = np.random.default_rng(4)
    vectors = (100_000 + random.integers(0, 3, (40, 3)) / 64).tolist()
    _, found = _all(_rows(spark, vectors))
    _held_against_numpy(found, vectors, list(range(40)))


def test_without_rows_or_spread(spark):
    assert whitening.fit(_rows(spark, [])) is None
    assert _all(_rows(spark, []))[1] == [] and _all(_rows(spark, [None, None]))[1] == []
    assert _all(_rows(spark, [[1.0, 2.0]]))[1] == []
    model, found = _all(_rows(spark, [[1.0, 2.0, 3.0], [2.0, 2.0, 3.0]]))
    assert [r.component for r in found] == [1, 1] and len(model.variances) == 1
    assert _all(_rows(spark, [[], []]))[1] == []


def test_lengths_must_agree(spark):
    with pytest.raises(Exception, match="different lengths"):
        whitening.fit(_rows(spark, [[1.0, 2.0], [1.0]]))


def test_deviations_beyond_doubles_are_exact():
    model = whitening.Whitening(10**7, [10**7 * 10**6 + 3] * 2, np.eye(2), np.ones(2), 2.0)
    x = np.array([[1_000_100, 999_990]])
    assert model.deviations(x).tolist() == [sum((10**7 * int(v) - s) ** 2 for v, s in zip(x[0], model.sums, strict=True))]
    with pytest.raises(OverflowError):
        model.deviations(np.array([[10**9, 0]]))
