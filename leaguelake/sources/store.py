"""Stored tables: where they lie, how they are written, and cuts in a long lineage."""

from __future__ import annotations

import gc
import json
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leaguelake.sources.schemas import PARTITIONS, SCHEMAS, UNIT


@cache
def _local_fallback() -> str:
    return tempfile.mkdtemp(prefix="leaguelake-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches, named by spark.checkpoint.dir.

    A local session without that setting gets a temporary folder; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_fallback()
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def session_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/leaguelake/{spark.sparkContext.applicationId}"


def clear_session(spark: SparkSession) -> None:
    """Drops everything this session stored for its own use."""
    remove(spark, session_folder(spark))


def let_go(spark: SparkSession) -> None:
    """Drops what finished steps left behind: Spark removes shuffle files, broadcasts and generated code once no
    object on the driver refers to them, which it learns when memory is collected."""
    gc.collect()
    spark._jvm.System.gc()


#: The folder of the cuts of this thread, unless they are the session's.
_cuts: ContextVar[str | None] = ContextVar("cuts", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for what this thread cuts inside, removed at the end: for steps that leave nothing but stored tables."""
    folder = f"{session_folder(spark)}/cuts/{uuid.uuid4().hex}"
    before = _cuts.set(folder)
    try:
        yield folder
    finally:
        _cuts.reset(before)
        remove(spark, folder)


def cut(df: DataFrame, label: str, partition_by: Sequence[str] = (), folder: str | None = None) -> DataFrame:
    """Writes df once and reads it back: a fixed, re-readable result that outlives its executors."""
    spark = df.sparkSession
    folder = folder or _cuts.get() or f"{session_folder(spark)}/cuts"
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return read_stored(spark, path, df.schema)


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], keep_others: bool, gathered: bool = False,
    metrics: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """Writes df by partition, replacing only the partitions it holds or the whole table.

    The rebalance hint groups rows by partition before the write, while adaptive execution still
    splits a partition too large for one task and merges the small ones. Rows `gathered` by
    partition already, as a projection of a table stored the same way is, are written as they come.
    Returns the aggregates `metrics`, observed while the rows are written: behind the shuffle, so that
    the rows of a task that runs again count once. Without rows it returns none.
    """
    rows = df if gathered else df.hint("rebalance", *partition_by)
    seen = Observation() if metrics else None
    if seen is not None:
        rows = rows.observe(seen, *[c.alias(name) for name, c in metrics.items()])
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if keep_others else "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return observed(seen) if seen is not None else {}


def observed(seen: Observation) -> dict[str, int]:
    """The metrics of a finished write; empty if nothing had to be run, as for a table known to be empty."""
    return dict(seen.get) if seen._jo.getOrEmpty().size() else {}


def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reads with a given schema, so partition values keep their declared type (season is text)."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, jvm_path = _file_system(spark, path)
    return file_system.exists(jvm_path)


def remove(spark: SparkSession, path: str) -> None:
    file_system, jvm_path = _file_system(spark, path)
    file_system.delete(jvm_path, True)


def file_names(spark: SparkSession, folder: str) -> set[str]:
    file_system, jvm_path = _file_system(spark, folder)
    if not file_system.exists(jvm_path):
        return set()
    return {status.getPath().getName() for status in file_system.listStatus(jvm_path)}


# The characters Hive-style partition folders spell as %XX, besides control characters.
ESCAPED_IN_FOLDERS = "\"#%'*/:=?\\\x7f{[]^"


def unit_folder(path: str, unit: tuple[str, str]) -> str:
    def escaped(value: str) -> str:
        return "".join(f"%{ord(c):02X}" if c in ESCAPED_IN_FOLDERS or c < " " else c for c in value)

    return "/".join([path, *(f"{name}={escaped(value)}" for name, value in zip(UNIT, unit, strict=True))])


def write_text(spark: SparkSession, path: str, text: str) -> None:
    file_system, jvm_path = _file_system(spark, path)
    stream = file_system.create(jvm_path, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


Units = Sequence[tuple[str, str]] | DataFrame


def units_table(spark: SparkSession, units: Units) -> DataFrame:
    """(competition, season) units as a table, once each. A list is for a handful of them."""
    if not isinstance(units, DataFrame):
        units = spark.createDataFrame([tuple(u) for u in units], f"{UNIT[0]} string, {UNIT[1]} string")
    return units.select(*UNIT).distinct()


def within(df: DataFrame, units: DataFrame) -> DataFrame:
    """The rows of the given units. Of a table stored by unit only their folders are read.

    Spark prunes folders at run time by a joined table that it takes for selective, which is one with a comparison.
    """
    return df.join(units.filter(F.col(UNIT[0]) >= ""), list(UNIT), "left_semi").select(*df.columns)


class Lake:
    """The stored tables below one root folder, each layer a sub-folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def land(self, name: str, df: DataFrame, metrics: Mapping[str, Column] | None = None) -> dict[str, int]:
        """Adds a load to a RAW table, replacing only an earlier copy of the same run."""
        rows = df.select(*SCHEMAS[name].names)
        return write_partitioned(rows, self.path("raw", name), PARTITIONS[name], keep_others=True, metrics=metrics)

    def append_audit(self, name: str, df: DataFrame, metrics: Mapping[str, Column] | None = None) -> dict[str, int]:
        """Adds rows to an audit table. Those kept by run replace what the same run wrote before."""
        path, rows = self.path("audit", name), df.select(*SCHEMAS[name].names)
        if name in PARTITIONS:
            return write_partitioned(rows, path, PARTITIONS[name], keep_others=True, metrics=metrics)
        rows.write.mode("append").parquet(path)
        return {}

    def contract(self, name: str, layer: str = "raw") -> DataFrame:
        """Reads a RAW or AUDIT table; one never written reads as empty."""
        path, schema = self.path(layer, name), SCHEMAS[name]
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return read_stored(self.spark, path, schema)

    def raw(self, name: str) -> DataFrame:
        return self.contract(name, "raw")

    def audit(self, name: str) -> DataFrame:
        return self.contract(name, "audit")

    def save(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Replaces a small table that has no units and reads it back."""
        df.write.mode("overwrite").parquet(self.path(layer, name))
        return self._opened(layer, name, df.schema)

    def save_all_units(self, layer: str, name: str, df: DataFrame, gathered: bool = False) -> DataFrame:
        """Replaces a whole table stored by (competition, season) and reads it back."""
        write_partitioned(df, self.path(layer, name), UNIT, keep_others=False, gathered=gathered)
        return self._opened(layer, name, df.schema)

    def unit_files(self, layer: str, name: str, units: DataFrame) -> DataFrame:
        """competition_code, season, file: the files of a stored table's units. No column is read for it."""
        path, schema = self.path(layer, name), f"{UNIT[0]} string, {UNIT[1]} string"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], f"{schema}, file string")
        rows = self.spark.read.schema(schema).parquet(path)
        listed = rows.select(*UNIT, F.col("_metadata.file_path").alias("file"))
        return within(listed, units).distinct()

    def save_units(
        self, layer: str, name: str, df: DataFrame, units: Units, gathered: bool = False, before: DataFrame | None = None
    ) -> DataFrame:
        """Replaces the given (competition, season) units of a table and reads those back.

        Each write swaps whole partition folders. A unit left without rows is not part of the write and still
        holds a file it had `before`; its folder is removed, one by one, as such units are the exception.
        """
        units = units_table(self.spark, units)
        if before is None:
            before = cut(self.unit_files(layer, name, units), "files")
        path = self.path(layer, name)
        write_partitioned(df, path, UNIT, keep_others=True, gathered=gathered)
        kept = self.unit_files(layer, name, units).join(before, [*UNIT, "file"], "left_semi").select(*UNIT).distinct()
        for unit in kept.toLocalIterator():
            remove(self.spark, unit_folder(path, tuple(unit)))
        return within(self._opened(layer, name, df.schema), units)

    def stored(self, layer: str, name: str) -> DataFrame:
        """Opens a stored model by the schema kept with it, so an empty table keeps its columns."""
        path = self.path(layer, name)
        text = self.spark.read.text(self._schema_path(layer, name), wholetext=True).first()[0]
        return read_stored(self.spark, path, T.StructType.fromJson(json.loads(text)))

    def _schema_path(self, layer: str, name: str) -> str:
        return f"{self.root}/schemas/{layer}.{name}.json"

    def _opened(self, layer: str, name: str, schema: T.StructType) -> DataFrame:
        write_text(self.spark, self._schema_path(layer, name), schema.json())
        return read_stored(self.spark, self.path(layer, name), schema)
