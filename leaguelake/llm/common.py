"""Column expressions and joins that several operators share."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Into how many parts the rows of one key are dealt before they are joined.
WAYS = 64


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. Pure ASCII takes the fast built-in."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(*columns: str | Column) -> Column:
    """128 bits that identify a row by the given columns, nulls included."""
    return F.struct(
        F.xxhash64(F.lit("a"), *columns).alias("a"), F.xxhash64(F.lit("b"), *columns).alias("b")
    )


def in_fold(id_column: str, folds: int, fold: int) -> Column:
    """True if crc32 of the id as text leaves `fold` modulo `folds`. A null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == fold, F.lit(False))


def grown(table: DataFrame) -> DataFrame:
    """A table that grows with the corpus: joined by sort-merge at every size, and neither side of the join is broadcast.

    Spark takes a scan for as large as its compressed files, and what an explode makes of it for hardly larger.
    """
    return table.hint("merge")


def attach(
    rows: DataFrame, lookup: DataFrame, key: list[str], spread: Column, how: str = "left", both_grow: bool = False
) -> DataFrame:
    """Joins `lookup`, unique by `key`, to rows of which one key may hold a large share.

    The rows of a key are dealt into WAYS parts. The parts in use are found with a pre-combined
    distinct, `lookup` is joined to these few, and the rows then join by key and part. If both tables grow with the
    corpus, none of them is broadcast.
    """
    dealt = rows.withColumn("_way", F.pmod(F.xxhash64(spread), F.lit(WAYS)).cast("int"))
    held = grown if both_grow else lambda table: table
    parts = dealt.select(*key, "_way").distinct().join(held(lookup), key, "inner")
    return dealt.join(held(parts), [*key, "_way"], how).drop("_way")


def keep_rows(docs: DataFrame, keys: DataFrame, *columns: str | Column) -> DataFrame:
    """The rows of docs whose row_key(*columns) is in `keys` (one struct column `row_key`), once each.

    Rows that agree in all these columns are the same document repeated, so one of them stays. The columns of docs
    travel as one struct: none is lost, whatever its name.
    """
    key = row_key(*columns)
    keyed = docs.select(F.struct("*").alias("row"), key["a"].alias("a"), key["b"].alias("b"))
    wanted = keys.select("row_key.a", "row_key.b").distinct()
    nth = F.row_number().over(Window.partitionBy("a", "b").orderBy("a"))
    once = keyed.join(grown(wanted), ["a", "b"], "left_semi").withColumn("nth", nth).where("nth = 1")
    return once.select("row.*")


def in_pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches cut into pieces of at most `rows` rows, so that a worker holds few texts as objects at a time."""
    for batch in batches:
        yield from (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def in_tasks(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """df.mapInArrow, with this package importable by the workers of a local session.

    Workers started on other machines need the package installed or sent with --py-files.
    """
    context = df.sparkSession.sparkContext
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        _give_back()

    return df.mapInArrow(run, schema)


def _give_back() -> None:
    """Returns memory that a finished task no longer needs to the machine: its worker lives on beside the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)
