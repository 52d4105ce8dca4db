"""Rebuilding only what a load touched.

A (competition, season) unit is closed under every model but two links: a match that moved between
units, and the team names shown in the league table. Both are followed, so a refresh leaves exactly
what a full rebuild would. Units are a table throughout: joined, never listed on the driver. What is to be
replaced is written down before the first table changes: a refresh that follows a failed one starts
from that note, as the tables no longer tell where a match was.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.plans import marts, match_index
from leaguelake.plans.models import Models
from leaguelake.sources.schemas import UNIT
from leaguelake.sources.store import Lake, Units, cut, exists, remove, units_table, within, write_text

NOTE = ("refresh", "unfinished.json")
SHOWN = ["team_id", "team_name", "team_crest_url"]


@dataclass(frozen=True)
class Note:
    """The folder of what an unfinished refresh set out to do: the units to replace, those from which, and the
    names shown before it. The note names the folder once all of it is written."""

    lake: Lake
    folder: str

    @classmethod
    def read(cls, lake: Lake) -> Note | None:
        if not exists(lake.spark, lake.path(*NOTE)):
            return None
        return cls(lake, json.loads(lake.spark.read.text(lake.path(*NOTE), wholetext=True).first()[0])["folder"])

    def table(self, name: str) -> DataFrame:
        return self.lake.spark.read.parquet(f"{self.folder}/{name}")

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.table(name)

    def announce(self) -> None:
        write_text(self.lake.spark, self.lake.path(*NOTE), json.dumps({"folder": self.folder}))

    def done(self) -> None:
        remove(self.lake.spark, self.lake.path(*NOTE))
        remove(self.lake.spark, self.folder)


def refresh(lake: Lake, units: Units) -> Models:
    """Replaces the given units in every stored model; the team and competition models always.

    Call it after each load with the units of that load. If the one before failed, its units are
    replaced along.
    """
    if not exists(lake.spark, lake.path("marts", "mart_league_table")):
        whole = Models(lake)
        whole.build()
        return whole
    units = units_table(lake.spark, units)
    left = Note.read(lake)
    note = Note(lake, lake.path("refresh", uuid.uuid4().hex))
    shown = left.table("teams") if left else lake.stored("marts", "dim_team").select(*SHOWN)
    shown = note.put("teams", shown)
    if left:
        units = units.unionByName(left.table("replaced"))

    # A match must go from the unit it left, so linked units are replaced along. The latest copy
    # of every match in the replaced units lies in those units or where it is staged now.
    units = cut(units.distinct(), "units")
    replaced = note.put("replaced", units.unionByName(match_index.linked_units(lake, units)).distinct())
    sources = replaced.unionByName(match_index.linked_units(lake, replaced))
    if left:
        sources = sources.unionByName(left.table("sources"))
    sources = note.put("sources", sources.distinct())
    note.announce()
    models = Models(lake, replaced, raw_units=sources)
    if replaced.isEmpty():
        models.stg_competitions, models.dim_team  # noqa: B018
    else:
        models.build()
        match_index.update(lake, models.stg_matches)
    _refresh_names(lake, models, shown)
    note.done()
    if left:
        remove(lake.spark, left.folder)
    return models


def _refresh_names(lake: Lake, models: Models, shown_before: DataFrame) -> None:
    """Rebuilds the league table of other units that show a team whose name or crest changed."""
    now = models.dim_team.select(*SHOWN)
    changed = now.exceptAll(shown_before).unionByName(shown_before.exceptAll(now)).select("team_id").distinct()
    changed = cut(changed, "teams_changed")
    if changed.isEmpty():
        return
    snapshots = lake.stored("marts", "fact_standing_snapshot")
    showing = snapshots.join(changed, "team_id", "left_semi").select(*UNIT).distinct()
    others = cut(showing.join(models.units, list(UNIT), "left_anti"), "units_showing")
    if others.isEmpty():
        return
    table = marts.mart_league_table(
        within(snapshots, others), models.dim_team, within(lake.stored("marts", "mart_team_form"), others)
    )
    lake.save_units("marts", "mart_league_table", table, others)


def touched_units(work: DataFrame) -> DataFrame:
    return work.filter(F.col("season").isNotNull()).select(*UNIT).distinct()
