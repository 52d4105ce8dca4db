"""Where each match is stored: match_id -> (competition, season), in parts by a hash of the id.

A refresh asks it in which units the matches of a load lie at present. Only the parts that hold one of the
asked ids are read, and only parts with a new or moved match are written again. The first refresh after a full
build makes the index from the staged ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.sources.schemas import UNIT
from leaguelake.sources.store import Lake, cut, exists, read_stored, remove, within, write_partitioned

#: Parts of the index. For a large lake: staged matches over some two million.
PARTS = 64
SCHEMA = "match_id string, competition_code string, season string, part int"
_PLACE = ("index", "match_units")


def _part() -> Column:
    return F.pmod(F.xxhash64("match_id"), F.lit(PARTS)).cast("int").alias("part")


def drop(lake: Lake) -> None:
    """Forgets the index, as before a full build."""
    if exists(lake.spark, lake.path(*_PLACE)):
        remove(lake.spark, lake.path(*_PLACE))


def _entries(matches: DataFrame) -> DataFrame:
    return matches.select("match_id", *UNIT, _part())


def _index(lake: Lake) -> DataFrame:
    path = lake.path(*_PLACE)
    if not exists(lake.spark, path):
        staged = lake.stored("staging", "stg_matches")
        write_partitioned(_entries(staged), path, ["part"], keep_others=False)
    schema = lake.spark.createDataFrame([], SCHEMA).schema
    if not exists(lake.spark, path):
        return lake.spark.createDataFrame([], schema)
    return read_stored(lake.spark, path, schema)


def _many(entries: DataFrame) -> DataFrame:
    """Entries that grow with the matches, and are never broadcast: a file of them is far smaller than they are in memory."""
    return entries.hint("merge")


def _parts_of(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The entries of the parts that hold one of the ids; other parts are not read.

    At most PARTS rows are broadcast. The comparison lets Spark take them for selective and prune by them.
    """
    parts = ids.select("part").distinct().filter(F.col("part") >= 0)
    return index.join(F.broadcast(parts), "part", "left_semi").select(*index.columns)


def located(lake: Lake, ids: DataFrame) -> DataFrame:
    """The entries of the given match_id."""
    asked = cut(ids.select("match_id", _part()).distinct(), "asked")
    return _parts_of(_index(lake), asked).join(_many(asked), ["part", "match_id"], "left_semi")


def linked_units(lake: Lake, units: DataFrame) -> DataFrame:
    """Units in which a match seen in the given units is stored at present.

    Only ids are read: those of the given units from RAW, pruned by folder, and the parts that hold them.
    """
    seen = within(lake.raw("raw_matches").select(*UNIT, "match_id"), units)
    return located(lake, seen.select("match_id")).select(*UNIT).distinct()


def update(lake: Lake, staged: DataFrame) -> None:
    """Takes over where the given staged matches lie now."""
    index = _index(lake)
    now = _entries(staged)
    changed = cut(now.join(_many(_parts_of(index, now)), now.columns, "left_anti"), "moved")
    if changed.isEmpty():
        return
    others = _parts_of(index, changed).join(_many(changed.select("match_id")), "match_id", "left_anti")
    renewed = cut(others.select(*now.columns).unionByName(changed), "index")
    write_partitioned(renewed, lake.path(*_PLACE), ["part"], keep_others=True)
