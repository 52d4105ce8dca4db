"""Best-fit packing by exact complements.

Documents become pieces of at most `capacity` ids. How pieces are combined depends on their lengths
alone, so the plan is made on the count of pieces of each length, a table of `capacity` numbers however
many documents there are. Going down from the longest length, the gap that it leaves is looked up
among the single lengths, the sums of two and the sums of three; combinations that fill it exactly are
used as often as the lengths in them are available. What no combination fills is packed best-fit,
longest first, whole length classes at a time. The plan says, for ranges of the pieces of each
length, in which sequence and at which offset they lie. The pieces are then numbered within their
length and look their place up.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leaguelake.llm.common import in_tasks
from leaguelake.llm.vocabulary import SPLIT, TextEncoder, vocabulary
from leaguelake.sources.store import cut

CAPACITY = 2048
#: The id that ends every document.
END = 0
#: Parts in which the pieces of one length are numbered.
PARTS = 4096

Combination = tuple[int, ...]


# -- the plan ------------------------------------------------------------------------------------


def _uses(left: list[int], lengths: Combination) -> int:
    """How often a combination can be made of what is left."""
    wanted: dict[int, int] = defaultdict(int)
    for n in lengths:
        wanted[n] += 1
    return min(left[n] // times for n, times in wanted.items())


def _pairs(left: np.ndarray, total: int) -> Iterator[Combination]:
    """Pairs of available lengths with this sum, the longest partner first."""
    big = np.arange(total - 1, (total - 1) // 2, -1)
    for a in big[(left[big] > 0) & (left[total - big] > 0)]:
        yield int(a), int(total - a)


def exact_fills(counts: np.ndarray, capacity: int) -> tuple[list[tuple[Combination, int]], np.ndarray]:
    """Combinations that fill a sequence exactly, with their numbers, and the counts left over."""
    left = counts.astype(np.int64).copy()
    fills: list[tuple[Combination, int]] = []

    def take(lengths: Combination) -> None:
        if times := _uses(left, lengths):
            fills.append((lengths, int(times)))
            for n in lengths:
                left[n] -= times

    take((capacity,))
    for longest in range(capacity - 1, 0, -1):
        if not left[longest]:
            continue
        gap = capacity - longest
        take((longest, gap))
        for pair in _pairs(left, gap):
            if not left[longest]:
                break
            take((longest, *pair))
        for third in range(gap - 2, 0, -1):
            if not left[longest]:
                break
            if left[third]:
                for pair in _pairs(left, gap - third):
                    take((longest, third, *pair))
                    if not left[longest] or not left[third]:
                        break
    return fills, left


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[Combination, int]]:
    """Packs whole classes of equal lengths, longest first, each where it leaves the least room."""
    open_gaps: dict[int, list[tuple[Combination, int]]] = defaultdict(list)
    gaps: list[int] = []

    def put(lengths: Combination, times: int) -> None:
        gap = capacity - sum(lengths)
        if not open_gaps[gap]:
            insort(gaps, gap)
        open_gaps[gap].append((lengths, times))

    for n in range(capacity, 0, -1):
        waiting = int(left[n])
        while waiting:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                each = capacity // n
                if full := waiting // each:
                    put((n,) * each, full)
                if rest := waiting % each:
                    put((n,) * rest, 1)
                break
            gap = gaps[at]
            lengths, times = open_gaps[gap].pop()
            if not open_gaps[gap]:
                gaps.pop(at)
            each = min(gap // n, waiting)
            done = min(times, waiting // each)
            if times > done:
                put(lengths, times - done)
            put(lengths + (n,) * each, done)
            waiting -= done * each
    return [one for group in open_gaps.values() for one in group]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, as ranges of their numbers sorted by (length, number).

    Arrays length, first (number of a range's first piece), sequence (its sequence; the next piece's is
    one more) and offset. Its size is bounded by the capacity, not by the number of pieces.
    """
    fills, left = exact_fills(counts, capacity)
    used = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for lengths, times in fills + best_fit(left, capacity):
        offset = 0
        for n in lengths:
            rows.append((n, int(used[n]), sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return dict(zip(("length", "first", "sequence", "offset"), table.T.copy(), strict=True))


# -- the pieces ----------------------------------------------------------------------------------


@cache
def _encoder(path: str) -> TextEncoder:
    import tiktoken

    words = vocabulary(path)
    library = tiktoken.Encoding("pieces", pat_str=SPLIT, mergeable_ranks=words.ids, special_tokens={})
    return TextEncoder(words, lambda piece: library.encode_ordinary(piece.decode()))


def piece_bounds(n: int, capacity: int) -> list[int]:
    """Where the pieces of n ids begin, and n. Only the first may be shorter than the capacity."""
    return [0, *range(n % capacity or min(n, capacity), n, capacity), n]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    encode, end = _encoder(path).encode, np.array([END], "<u4").tobytes()
    for batch in batches:
        rows, pieces, starts, lengths, sums = [], [], [], [], []
        for row, text in enumerate(batch.column("text")):
            ids = memoryview(encode(text.as_py() or "") + end)
            bounds = piece_bounds(len(ids) // 4, capacity)
            for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                rows.append(row)
                pieces.append(piece)
                starts.append(a)
                lengths.append(b - a)
                sums.append(zlib.crc32(ids[4 * a : 4 * b]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(pa.array(rows, pa.int64())),
                pa.array(pieces, pa.int32()), *[pa.array(x, pa.int64()) for x in (starts, lengths, sums)],
            ],
            ["id", "piece", "start", "length", "ids_crc32"],
        )


def _placed(batches: Iterator[pa.RecordBatch], places: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Looks up the range that holds each piece's number."""
    reach = np.int64(1) << 40
    keys = places["length"] * reach + places["first"]
    for batch in batches:
        length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
        at = np.searchsorted(keys, length * reach + number, "right") - 1
        sequence = places["sequence"][at] + number - places["first"][at]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")),
             pa.array(sequence), pa.array(places["offset"][at])],
            ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def packed(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Every document is its ids by the vocabulary at `path`, then END; a null or empty text is END alone.
    Each row of docs is packed, rows that repeat an id included; null ids stay null. Other columns
    are not read, whatever their names. Offsets in a sequence have no gaps. No documents, no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    base = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    made = in_tasks(rows, partial(_pieces, path=path, capacity=capacity), base)
    pieces = cut(made.withColumn("part", F.spark_partition_id() % PARTS), "pieces")

    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    starts = per_part.select("length", "part", before.alias("before"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").agg(F.count("*")).collect():  # at most `capacity` rows
        counts[length] = n
    places = plan(counts, capacity)

    order = Window.partitionBy("length", "part").orderBy("id", "piece", "start", "ids_crc32")
    numbered = (
        pieces.join(starts, ["length", "part"])
        .withColumn("number", F.col("before") + F.row_number().over(order) - 1).drop("before", "part")
    )
    return in_tasks(numbered, partial(_placed, places=places), f"{base}, sequence_id bigint, offset bigint")
