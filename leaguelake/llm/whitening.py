"""Whitening of embeddings: projection on the leading components of their covariance, scaled to variance one.

Vectors are taken as whole numbers, floor(SCALE * entry) + SHIFT. Two passes over them fit the model: sums and
count, then the sums of products of entries less the rounded mean. Both are sums of whole numbers, so they do not
depend on how rows are dealt, and the covariance that follows from them is exact before its last rounding. The
matrix, as wide as a vector is long, is taken apart on the driver (`eigen`), and the components go to the tasks
that project. A last pass measures the covariance of what they give.

Rows whose vector is null or has a null or non-finite entry are left out; rows that repeat count as often as
they come, also those with a null id, and equal vectors get equal results. Without rows, or without any spread, nothing
is returned; components without spread are left out. Vectors of different lengths, and numbers too large for
a long, are errors. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.common import in_tasks
from leaguelake.llm.eigen import leading
from leaguelake.llm.vectors import as_matrix, is_whole, whole_numbers

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: A component with less than this share of the largest variance is rounding, not spread.
LEAST_SHARE = 1e-12
#: Rows worked on at a time.
ROWS = 2048

_EXACT = 2.0**53


@dataclass(frozen=True)
class Whitening:
    """What was learned from n vectors: their sums, and the components as columns with variances."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total: float

    @property
    def centre(self) -> np.ndarray:
        """The mean of each dimension, rounded."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    def project(self, x: np.ndarray) -> np.ndarray:
        centre = self.centre
        rest = np.array([(s - self.n * int(c)) / self.n for s, c in zip(self.sums, centre, strict=True)])
        return ((x - centre).astype(np.float64) - rest) @ self.components / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """For each row the sum over dimensions of (n * x - sum) ** 2, exactly."""
        offset = x - self.centre
        rest = [s - self.n * int(c) for s, c in zip(self.sums, self.centre, strict=True)]
        largest = self.n * int(np.abs(offset).max(initial=0)) + self.n
        if largest**2 * max(len(rest), 1) < 1 << 63:
            return ((self.n * offset - np.array(rest, np.int64)) ** 2).sum(axis=1)
        apart = self.n * offset.astype(object) - np.array(rest, object)
        exact = (apart * apart).sum(axis=1)
        if exact.max() >= 1 << 63:
            raise OverflowError("a deviation is too large to be a long")
        return exact.astype(np.int64)


def _numbers(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for i in range(0, batch.num_rows, ROWS):
        some = batch.slice(i, ROWS)
        yield some, whole_numbers(as_matrix(some.column("vector")), SCALE) + SHIFT


def _whole(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return rows.where(is_whole(F.col(vector_col))).select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each dimension and task: i, the sum, and how many vectors there were."""
    sums, n = None, 0
    for batch in batches:
        for _, x in _numbers(batch):
            part = x.sum(axis=0, dtype=np.int64)
            if sums is not None and len(part) != len(sums):
                raise ValueError(f"vectors of different lengths: {sorted({len(part), len(sums)})}")
            sums = part if sums is None else sums + part
            n += len(x)
    if sums is not None:
        d = len(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()), pa.array(sums), pa.array([n] * d, pa.int64())], ["i", "total", "n"]
        )


def _exact_products(offset: np.ndarray) -> np.ndarray:
    """offset.T @ offset in whole numbers; in doubles where no sum can be rounded."""
    largest = float(np.abs(offset).max(initial=0))
    if largest * largest * len(offset) < _EXACT:
        wide = offset.astype(np.float64)
        return (wide.T @ wide).astype(np.int64)
    if largest * largest * len(offset) >= 2.0**62:
        raise OverflowError("the spread of the vectors is too large for sums of longs")
    return offset.T @ offset


def _products(batches: Iterator[pa.RecordBatch], centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The upper half of the sums of products of this task: i, j, value."""
    sums = None
    for batch in batches:
        for _, x in _numbers(batch):
            part = _exact_products(x - centre)
            sums = part if sums is None else sums + part
            if sums.max(initial=0) >= 1 << 62:
                raise OverflowError("the spread of the vectors is too large for sums of longs")
    if sums is not None:
        i, j = np.triu_indices(len(sums))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(sums[i, j])], ["i", "j", "value"]
        )


def fit(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> Whitening | None:
    """The whitening of all whole vectors, to at most k components; None if there are none.

    To the driver come one number for each dimension and one for each pair of them.
    """
    vectors = _whole(rows, id_col, vector_col)
    summed = in_tasks(vectors, _sums, "i int, total bigint, n bigint").groupBy("i")
    found = summed.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).orderBy("i").collect()
    if not found:
        return None
    if len({r.n for r in found}) > 1:
        raise ValueError("vectors of different lengths")
    n, sums, d = found[0].n, [int(r.total) for r in found], len(found)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    parts = in_tasks(vectors, partial(_products, centre=centre), "i int, j int, value bigint").groupBy("i", "j")
    products = parts.agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    covariance, total = np.zeros((d, d)), 0
    for r in products:
        exact = n * int(r.value) - rest[r.i] * rest[r.j]  # n * n times the covariance, a whole number
        covariance[r.i, r.j] = covariance[r.j, r.i] = exact / (n * n)
        total += exact if r.i == r.j else 0
    values, components = leading(covariance, min(k, d))
    kept = values > LEAST_SHARE * max(values.max(initial=0.0), 0.0)
    return Whitening(n, sums, components[:, kept], values[kept], total / (n * n))


def _squares(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    k = len(model.variances)
    sums, products = np.zeros(k), np.zeros((k, k))
    for batch in batches:
        for _, x in _numbers(batch):
            y = model.project(x)
            sums += y.sum(axis=0)
            products += y.T @ y
    table = np.vstack([sums, products])
    i, j = np.indices(table.shape)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(table.ravel())], ["i", "j", "value"]
    )


def identity_error(rows: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """The largest entry, by size, of the covariance of the whitened vectors less the identity."""
    k = len(model.variances)
    if not k:
        return 0.0
    parts = in_tasks(_whole(rows, id_col, vector_col), partial(_squares, model=model), "i int, j int, value double")
    table = np.zeros((k + 1, k))
    for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        table[r.i, r.j] = r.value
    mean = table[0] / model.n
    return float(np.abs(table[1:] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _lines(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    k = len(model.variances)
    shares = model.variances / model.total
    for batch in batches:
        for some, x in _numbers(batch):
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    some.column("id").take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array(np.repeat(model.deviations(x), k)),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(shares, m)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained"],
            )


def whitened(rows: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained of every whole vector and component."""
    vectors = _whole(rows, id_col, vector_col)
    schema = f"id {dict(vectors.dtypes)['id']}, component int, n bigint, deviation bigint, whitened double, explained double"
    if model is None or not len(model.variances):
        return rows.sparkSession.createDataFrame([], schema)
    return in_tasks(vectors, partial(_lines, model=model), schema)
