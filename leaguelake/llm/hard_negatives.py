"""Hard negatives: for an anchor and one of its positives, the best-scoring rows of other labels within a window below
the positive's score.

Every positive opens a window of scores that ends at its own. The upper ends of an anchor's windows cut its scores into
slots that do not overlap, so one pass serves all windows: each task keeps the top rows of every slot, the tops of
all tasks are cut to the top of a slot, and a window, which is a row of slots from its upper end down, takes the
first rows of these slots that lie above its lower end.

Anchors are a stated share of the rows and grow with them. They are worked on in rounds of a bounded number
of entries, broadcast each, against all rows in blocks; nothing but the tops of a task is shuffled.

Scores are inner products of whole numbers, floor(SCALE * entry), and exact. Rows with a null id, label or vector,
or a null or non-finite entry take no part. Rows that repeat are rows of their own: an anchor's copy is another row.
Ties go to the smaller id. Vectors of different lengths and scores beyond a long are errors.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leaguelake.llm.common import in_tasks
from leaguelake.llm.vectors import is_whole, length_of
from leaguelake.sources.store import cut, session_folder

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: The window of a positive: from this many hundredths of its score up to it.
LOWEST, HIGHEST = 80, 100
#: Entries of the anchors of a round, and scores computed at a time.
ROUND_ENTRIES = 1 << 20
BLOCK_SCORES = 1 << 21

_NONE = np.iinfo(np.int64).min
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def vectors(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """uid, id, label, x of the rows that take part; stored, so that uid stays the same for a row."""
    there = F.col(id_col).isNotNull() & label.isNotNull() & is_whole(F.col(vector_col))
    whole = F.transform(vector_col, lambda c: F.floor(SCALE * c.cast("double")))
    numbered = rows.where(there).select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"), whole.alias("x"),
    )
    return cut(numbered, "vectors")


class _Tops:
    """The first `k` of every group by falling score, then id, then uid."""

    def __init__(self, groups: int, k: int) -> None:
        self.k = k
        # What a row must come before to enter a group that is full.
        self.least = np.full(groups, _NONE)
        self.least_id = np.full(groups, np.iinfo(np.int64).max)
        self.held = [np.empty(0, np.int64)] * 4

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, uid: np.ndarray) -> None:
        least = self.least[group]
        enters = (score > least) | ((score == least) & (ids <= self.least_id[group]))
        group, score, ids, uid = (
            np.concatenate([old, new[enters]]) for old, new in zip(self.held, (group, score, ids, uid), strict=True)
        )
        order = np.lexsort((uid, ids, -score, group))
        group = group[order]
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        order, group = order[rank < self.k], group[rank < self.k]
        self.held = [group, score[order], ids[order], uid[order]]
        full = np.flatnonzero(rank[rank < self.k] == self.k - 1)
        self.least[group[full]], self.least_id[group[full]] = self.held[1][full], self.held[2][full]


@dataclass(frozen=True)
class _Anchors:
    """The anchors of a round, as they are broadcast."""

    uid: np.ndarray
    label: np.ndarray
    x: np.ndarray
    #: Upper ends of each anchor's windows, falling and distinct, filled up with _NONE; not known in the first pass.
    ends: np.ndarray | None = None


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes != width).any():
        raise ValueError("vectors of different lengths")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers; by doubles where none can be rounded."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2.0**53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if bound >= 2.0**62 / HIGHEST:
        raise OverflowError("scores beyond a long")
    return a @ b.T


def _blocks(batch: pa.RecordBatch, anchors: _Anchors) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """uid, id, label and scores (by anchor) of a few rows at a time."""
    step = max(1, BLOCK_SCORES // max(1, len(anchors.uid)))
    for i in range(0, batch.num_rows, step):
        some = batch.slice(i, step)
        uid, ids, label = (some.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "id", "label"))
        yield uid, ids, label, _scores(anchors.x, _matrix(some.column("x"), anchors.x.shape[1]))


def _table(tops: _Tops, slots: int) -> pa.RecordBatch:
    group, score, ids, uid = tops.held
    return pa.RecordBatch.from_arrays(
        [pa.array((group // slots).astype(np.int32)), pa.array((group % slots).astype(np.int32)),
         *map(pa.array, (score, ids, uid))],
        ["a", "slot", "score", "id", "uid"],
    )


_TOPS = "a int, slot int, score bigint, id bigint, uid bigint"


def _positives(batches: Iterator[pa.RecordBatch], anchors: _Anchors, k: int) -> Iterator[pa.RecordBatch]:
    tops = _Tops(len(anchors.uid), k)
    for batch in batches:
        for uid, ids, label, scores in _blocks(batch, anchors):
            fits = (anchors.label[:, None] == label) & (scores >= tops.least[:, None])
            a, row = np.nonzero(fits)
            other = anchors.uid[a] != uid[row]
            a, row = a[other], row[other]
            tops.add(a, scores[a, row].astype(np.int64), ids[row], uid[row])
    yield _table(tops, 1)


def _negatives(batches: Iterator[pa.RecordBatch], anchors: _Anchors, k: int) -> Iterator[pa.RecordBatch]:
    ends = anchors.ends
    slots = ends.shape[1]
    last = np.where(ends == _NONE, ends[:, :1], ends).min(axis=1)
    # Lower than the lowest window, by rounding at most: what passes is tested exactly.
    lowest = np.floor(last * (LOWEST / HIGHEST)) - 1 - np.abs(last) * 1e-12
    tops = _Tops(len(ends) * slots, k)
    for batch in batches:
        for uid, ids, label, scores in _blocks(batch, anchors):
            fits = (scores <= ends[:, :1]) & (scores >= lowest[:, None]) & (anchors.label[:, None] != label)
            a, row = np.nonzero(fits)
            score = scores[a, row].astype(np.int64)
            # The slot of a score ends at the smallest upper end not below it.
            slot = (ends[a] >= score[:, None]).sum(axis=1) - 1
            within = HIGHEST * score >= LOWEST * ends[a, slot]
            a, row, score, slot = a[within], row[within], score[within], slot[within]
            tops.add(a * slots + slot, score, ids[row], uid[row])
    yield _table(tops, slots)


def _first(tops: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k of each group over all tasks; Spark cuts each task's rows to k before they are shuffled."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id", "uid")
    return tops.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _round(rows: DataFrame, chosen: DataFrame, k_positive: int, k_negative: int) -> DataFrame:
    """The result for a bounded number of anchors."""
    context = rows.sparkSession.sparkContext
    found = chosen.select("uid", "id", "label", "x").toArrow().combine_chunks()
    width = len(found.column("x")[0])
    uid, ids, label = (found.column(c).to_numpy() for c in ("uid", "id", "label"))
    x = _matrix(found.column("x").combine_chunks(), width)

    def scan(anchors: _Anchors, work, k: int) -> DataFrame:
        sent = context.broadcast(anchors)
        result = cut(in_tasks(rows, lambda batches: work(batches, sent.value, k), _TOPS), "tops")
        sent.destroy()
        return result

    positives = cut(_first(scan(_Anchors(uid, label, x), _positives, k_positive), ["a"], k_positive), "positives")
    # At most k_positive numbers for each anchor of the round.
    limits = positives.select("a", "score").distinct().orderBy("a", F.desc("score")).toArrow()
    a, score = limits.column("a").to_numpy(), limits.column("score").to_numpy()
    ends = np.full((len(uid), k_positive), _NONE)
    ends[a, np.arange(len(a)) - np.searchsorted(a, a)] = score
    tops = scan(_Anchors(uid, label, x, ends), _negatives, k_negative)
    slots = _first(tops, ["a", "slot"], k_negative).drop("place")
    windows = positives.select(
        "a", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        # How many upper ends of the anchor lie above this one: the first slot of the window.
        (F.dense_rank().over(Window.partitionBy("a").orderBy(F.desc("score"))) - 1).alias("first"),
    )
    inside = (F.col("slot") >= F.col("first")) & (HIGHEST * F.col("score") >= LOWEST * F.col("positive_score"))
    merged = windows.join(slots, "a").where(inside)
    order = Window.partitionBy("a", "place").orderBy(F.desc("score"), "id", "uid")
    names = rows.sparkSession.createDataFrame(pa.table({"a": np.arange(len(ids), dtype=np.int32), "anchor_id": ids}))
    return (
        merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k_negative)
        .join(names, "a")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"))
    )


def mined(rows: DataFrame, anchors: Column, k_positive: int = POSITIVES, k_negative: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows of `vectors`.

    `anchors` says which rows are anchors. An anchor's positives are the first k_positive other rows of
    its label; of each, the first k_negative rows of other labels in the window are returned.
    """
    spark = rows.sparkSession
    asked = rows.where(anchors)
    count, width = asked.count(), max(1, length_of(asked, "x"))
    if not count:
        return spark.createDataFrame([], RESULT)
    # Rounds are drawn by hash and half full on average, so that none exceeds its bound.
    rounds = math.ceil(count * width / (ROUND_ENTRIES / 2)) if count * width > ROUND_ENTRIES else 1
    asked = cut(asked.withColumn("round", F.pmod(F.xxhash64("uid"), F.lit(rounds)).cast("int")), "anchors", ["round"])
    path = f"{session_folder(spark)}/cuts/mined-{uuid.uuid4().hex}"
    for i in range(rounds):
        chosen = asked.where(F.col("round") == i)
        if not chosen.isEmpty():
            _round(rows, chosen, k_positive, k_negative).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)
