"""The eighteen models over one lake, each stored on first use.

Staging, intermediate, dimension, fact and mart tables are written by (competition, season) unit.
A model reads the stored columns of the ones below it, so the payloads are shuffled and unpacked
once, whatever is built above them. With `units`, a table of them, only those are computed and replaced.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.plans import dimensions, facts, intermediate, marts, match_index, staging
from leaguelake.sources.schemas import UNIT
from leaguelake.sources.store import Lake, Units, cut, let_go, scratch, units_table, within

MODEL_NAMES = (
    "stg_competitions", "stg_teams", "stg_matches", "stg_standings",
    "int_match_team_performance", "int_table_progression",
    "dim_team", "dim_season", "dim_matchweek", "dim_date",
    "fact_match", "fact_team_match", "fact_standing_snapshot",
    "mart_team_form", "mart_home_away_performance", "mart_goal_analysis",
    "mart_league_progression", "mart_league_table",
)


#: The models by what they need: every wave reads earlier waves only. The two with the most shuffle files,
#: int_table_progression and mart_team_form, are in different ones, as the files of a wave go when it ends.
WAVES = (
    ("stg_matches", "stg_teams", "stg_standings", "stg_competitions"),
    ("int_match_team_performance", "fact_match", "dim_season", "dim_matchweek", "dim_team", "dim_date"),
    ("int_table_progression", "fact_team_match", "mart_home_away_performance", "mart_goal_analysis"),
    ("fact_standing_snapshot", "mart_team_form"),
    ("mart_league_progression", "mart_league_table"),
)
LAYERS = {"stg": "staging", "int": "intermediate"}
#: Replaced whole at every build: they look across units.
WHOLE = ("stg_competitions", "stg_teams", "dim_team", "dim_date")


def layer_of(name: str) -> str:
    return LAYERS.get(name.split("_")[0], "marts")


class Models:
    """The calendar has fixed bounds, or with `calendar_of_matches` spans the matches."""

    def __init__(
        self, lake: Lake, units: Units | None = None, raw_units: Units | None = None,
        calendar_of_matches: bool = False,
    ) -> None:
        self.lake = lake
        self.units = None if units is None else units_table(lake.spark, units)
        self.raw_units = self.units if raw_units is None else units_table(lake.spark, raw_units)
        self.calendar_of_matches = calendar_of_matches

    @cached_property
    def _files_before(self) -> DataFrame:
        """Which files the units had in every table before the first of them is replaced, found in one job."""
        names = [name for name in MODEL_NAMES if name not in WHOLE]
        listed = [
            self.lake.unit_files(layer_of(name), name, self.units).select(F.lit(name).alias("model"), *UNIT, "file")
            for name in names
        ]
        return cut(reduce(DataFrame.unionAll, listed), "files")

    def _raw(self, name: str) -> DataFrame:
        rows = self.lake.raw(name)
        return rows if self.raw_units is None else within(rows, self.raw_units)

    def _by_unit(self, layer: str, name: str, df: DataFrame, projected: bool = False) -> DataFrame:
        """Stores by unit; a row-by-row projection of a table stored by unit needs no shuffle."""
        if self.units is None:
            return self.lake.save_all_units(layer, name, df, projected)
        before = self._files_before.filter(F.col("model") == name).drop("model")
        return self.lake.save_units(layer, name, within(df, self.units), self.units, projected, before)

    @cached_property
    def stg_competitions(self) -> DataFrame:
        return self.lake.save("staging", "stg_competitions", staging.stg_competitions(self.lake.raw("raw_competitions")))

    @cached_property
    def stg_teams(self) -> DataFrame:
        """Always whole: dim_team looks across seasons."""
        return self.lake.save("staging", "stg_teams", staging.stg_teams(self.lake.raw("raw_teams")))

    @cached_property
    def stg_matches(self) -> DataFrame:
        if self.units is None:
            match_index.drop(self.lake)
        return self._by_unit("staging", "stg_matches", staging.stg_matches(self._raw("raw_matches")))

    @cached_property
    def stg_standings(self) -> DataFrame:
        return self._by_unit("staging", "stg_standings", staging.stg_standings(self._raw("raw_standings")))

    @cached_property
    def int_match_team_performance(self) -> DataFrame:
        return self._by_unit(
            "intermediate",
            "int_match_team_performance",
            intermediate.match_team_performance(self.stg_matches),
            projected=True,
        )

    @cached_property
    def int_table_progression(self) -> DataFrame:
        performance = self.int_match_team_performance
        with scratch(self.lake.spark):  # the records that are ranked
            return self._by_unit("intermediate", "int_table_progression", intermediate.table_progression(performance))

    @cached_property
    def dim_team(self) -> DataFrame:
        return self.lake.save("marts", "dim_team", dimensions.dim_team(self.stg_teams))

    @cached_property
    def dim_season(self) -> DataFrame:
        return self._by_unit("marts", "dim_season", dimensions.dim_season(self.stg_matches))

    @cached_property
    def dim_matchweek(self) -> DataFrame:
        return self._by_unit("marts", "dim_matchweek", dimensions.dim_matchweek(self.stg_matches))

    @cached_property
    def dim_date(self) -> DataFrame:
        matches = self.stg_matches if self.calendar_of_matches else None
        return self.lake.save("marts", "dim_date", dimensions.dim_date(self.lake.spark, matches=matches))

    @cached_property
    def fact_match(self) -> DataFrame:
        return self._by_unit("marts", "fact_match", facts.fact_match(self.stg_matches), projected=True)

    @cached_property
    def fact_team_match(self) -> DataFrame:
        return self._by_unit(
            "marts", "fact_team_match", facts.fact_team_match(self.int_match_team_performance), projected=True
        )

    @cached_property
    def fact_standing_snapshot(self) -> DataFrame:
        return self._by_unit(
            "marts", "fact_standing_snapshot", facts.fact_standing_snapshot(self.int_table_progression), projected=True
        )

    @cached_property
    def mart_team_form(self) -> DataFrame:
        return self._by_unit("marts", "mart_team_form", marts.mart_team_form(self.int_match_team_performance))

    @cached_property
    def mart_home_away_performance(self) -> DataFrame:
        return self._by_unit(
            "marts", "mart_home_away_performance", marts.mart_home_away_performance(self.int_match_team_performance)
        )

    @cached_property
    def mart_goal_analysis(self) -> DataFrame:
        return self._by_unit("marts", "mart_goal_analysis", marts.mart_goal_analysis(self.int_match_team_performance))

    @cached_property
    def mart_league_progression(self) -> DataFrame:
        return self._by_unit(
            "marts", "mart_league_progression", marts.mart_league_progression(self.fact_standing_snapshot)
        )

    @cached_property
    def mart_league_table(self) -> DataFrame:
        return self._by_unit(
            "marts",
            "mart_league_table",
            marts.mart_league_table(self.fact_standing_snapshot, self.dim_team, self.mart_team_form),
        )

    def build(self) -> dict[str, DataFrame]:
        """Stores every model and returns them by name. Those of a wave need only earlier ones and are built at a time."""
        for name in ("raw_competitions", "raw_teams", "raw_matches", "raw_standings"):
            self.lake.raw(name)
        if self.units is not None:
            self._files_before  # noqa: B018
        with ThreadPoolExecutor(max(map(len, WAVES))) as pool:
            for wave in WAVES:
                list(pool.map(lambda name: getattr(self, name), wave))
                let_go(self.lake.spark)
        return {name: getattr(self, name) for name in MODEL_NAMES}
