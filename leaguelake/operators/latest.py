"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_latest_rank"


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keeps the first row of each key in the given order.

    Spark turns row_number() = 1 into a group limit that runs in every task before the shuffle, so
    a key with a great many copies sends at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
