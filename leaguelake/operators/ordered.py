"""Running totals, rolling frames, lags and ranks that no single key can hold up.

A window over a key sends all its rows to one task. Here every key is worked on in pieces, the same way
at every size: a piece is a fixed range of the order column (a month of kickoffs, a few matchweeks),
given by the caller.

* Running totals: one total row for each piece, the totals accumulated over the pieces of a key, and a window
  inside each piece that begins with what the earlier ones add up to.
* Rolling frames and lags: rows are numbered by such a running total and re-cut into blocks of equal
  length; the few rows that a frame reaches back are carried into the next block.
* Ranks: rows are counted by score first, and only the counts are accumulated.

Nothing is counted beforehand and nothing comes to the driver. All results equal the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows of one block of a rolling window.
BLOCK_ROWS = 4096
#: Scores that share a piece when ranks are accumulated.
SCORES_OF_PIECE = 16

_PIECE = "_piece"
_POSITION = "_position"
_BLOCK = "_block"
_CARRIED = "_carried"
_BROUGHT = "_brought"
_ROWS = "_rows"


def month_of(moment: str) -> Column:
    """The piece of a kickoff; a missing one has the last piece, as it sorts last."""
    months = F.year(moment) * 12 + F.month(moment)
    return F.coalesce(months, F.lit(1 << 30))


def range_of(number: str, width: int) -> Column:
    """The piece of a number; a missing one has the last piece, as it sorts last."""
    return F.coalesce(F.floor(F.col(number) / width).cast("long"), F.lit(1 << 60))


def _same(left_names: Sequence[str], right_names: Sequence[str]) -> Column:
    """Null-safe equality: a window treats null as a key of its own, so the joins here must too."""
    pairs = (F.col(left).eqNullSafe(F.col(right)) for left, right in zip(left_names, right_names, strict=True))
    return reduce(lambda a, b: a & b, pairs)


def _prefixed(names: Sequence[str]) -> list[str]:
    return [f"_right_{name}" for name in names]


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], piece: Column, sums: Mapping[str, Column]
) -> DataFrame:
    """Adds, per key, the sum of each expression from the first row through the current one.

    The order must be total within a key, and `piece` must not fall along it. `F.lit(1)` as expression
    gives the row number. What the earlier pieces of a key add up to is one more row of a piece, its first:
    the window that sums the piece begins with it, and no join is needed.
    """
    columns, kinds = df.columns, {field.name: field.dataType for field in df.schema}
    held = {name: f"_in_{name}" for name in sums}
    rows = df.select("*", piece.alias(_PIECE), *[c.cast("long").alias(held[name]) for name, c in sums.items()])
    totals = rows.groupBy(*keys, _PIECE).agg(*[F.sum(name).alias(name) for name in held.values()])
    earlier = Window.partitionBy(*keys).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    brought = totals.select(
        *[F.col(c) if c in keys else F.lit(None).cast(kinds[c]).alias(c) for c in columns],
        _PIECE,
        *[F.sum(name).over(earlier).alias(name) for name in held.values()],
    )
    both = rows.withColumn(_BROUGHT, F.lit(False)).unionByName(brought.withColumn(_BROUGHT, F.lit(True)))
    within = (
        Window.partitionBy(*keys, _PIECE).orderBy(F.col(_BROUGHT).desc(), *order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        both.select(*columns, _BROUGHT, *[F.sum(held[name]).over(within).alias(name) for name in sums])
        .filter(~F.col(_BROUGHT))
        .drop(_BROUGHT)
    )


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    piece: Column,
    reach: int,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
) -> DataFrame:
    """Adds window columns that look back at most `reach` rows within the key.

    Each column is a function of the ordered window, for example
    `lambda w: F.sum("points").over(w.rowsBetween(-4, 0))` or `lambda w: F.lag("points").over(w)`.
    """
    length = max(BLOCK_ROWS, reach + 1)
    placed = running_totals(df, keys, order, piece, {_POSITION: F.lit(1)})
    home = F.expr(f"({_POSITION} - 1) div {length}")
    last_rows = F.pmod(F.col(_POSITION) - 1, F.lit(length)) >= length - reach
    blocks = (
        placed.withColumn("_home", home)
        .withColumn(_BLOCK, F.explode(F.when(last_rows, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))))
        .withColumn(_CARRIED, F.col(_BLOCK) != F.col("_home"))
        .drop("_home")
    )
    in_block = Window.partitionBy(*keys, _BLOCK).orderBy(_POSITION)
    return (
        blocks.select("*", *[make(in_block).alias(name) for name, make in columns.items()])
        .filter(~F.col(_CARRIED))
        .drop(_POSITION, _BLOCK, _CARRIED)
    )


def rank_descending(df: DataFrame, keys: Sequence[str], scores: Sequence[str], name: str) -> DataFrame:
    """Adds the competition rank (ties share, gaps follow) by scores, highest first, nulls highest.

    The rank of a row is one more than the number of rows on better scores.
    """
    order = [F.col(score).desc_nulls_first() for score in scores]
    first = F.floor(F.col(scores[0]) / SCORES_OF_PIECE).cast("long")
    piece = F.coalesce(-first, F.lit(-(1 << 60)))
    tiers = df.groupBy(*keys, *scores).agg(F.count(F.lit(1)).alias(_ROWS))
    on = [*keys, *scores]
    names = _prefixed(on)
    ranked = running_totals(tiers, keys, order, piece, {"_through": F.col(_ROWS)}).select(
        *[F.col(k).alias(n) for k, n in zip(on, names, strict=True)],
        (F.col("_through") - F.col(_ROWS) + 1).alias(name),
    )
    return df.join(ranked, _same(on, names)).select(*df.columns, name)
