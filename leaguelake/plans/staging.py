"""RAW rows -> typed columns, one row per key: the latest load wins.

Fields are unpacked before the latest row is picked: the shuffle then carries a few typed columns
instead of whole payloads, and columns nobody reads are pruned from it. Loads are ordered by the time
each response was fetched, then by run, then by where it arrived: file time, file and line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.functions.expressions import field, fields
from leaguelake.operators.latest import latest_per_key

COMPETITION_FIELDS = {
    "competition_id": ("id", "bigint"),
    "competition_name": ("name", "string"),
    "competition_code_from_api": ("code", "string"),
    "competition_type": ("type", "string"),
    "area_name": ("area.name", "string"),
    "area_code": ("area.code", "string"),
    "current_season_id": ("currentSeason.id", "bigint"),
    "current_season_start_date": ("currentSeason.startDate", "date"),
    "current_season_end_date": ("currentSeason.endDate", "date"),
    "current_matchday": ("currentSeason.currentMatchday", "bigint"),
}
TEAM_FIELDS = {
    "team_name": ("name", "string"),
    "team_short_name": ("shortName", "string"),
    "team_tla": ("tla", "string"),
    "team_crest_url": ("crest", "string"),
    "founded_year": ("founded", "bigint"),
    "club_colors": ("clubColors", "string"),
    "venue_name": ("venue", "string"),
}
MATCH_FIELDS = {
    "matchweek": ("matchday", "bigint"),
    "kickoff_utc": ("utcDate", "timestamp_ntz"),
    "match_status": ("status", "string"),
    "match_stage": ("stage", "string"),
    "home_team_id": ("homeTeam.id", "bigint"),
    "home_team_name": ("homeTeam.name", "string"),
    "away_team_id": ("awayTeam.id", "bigint"),
    "away_team_name": ("awayTeam.name", "string"),
    "winner": ("score.winner", "string"),
    "full_time_home_goals": ("score.fullTime.home", "bigint"),
    "full_time_away_goals": ("score.fullTime.away", "bigint"),
    "half_time_home_goals": ("score.halfTime.home", "bigint"),
    "half_time_away_goals": ("score.halfTime.away", "bigint"),
}
STANDING_FIELDS = {
    "api_position": ("position", "bigint"),
    "team_id": ("team.id", "bigint"),
    "team_name": ("team.name", "string"),
    "played_games": ("playedGames", "bigint"),
    "won": ("won", "bigint"),
    "draw": ("draw", "bigint"),
    "lost": ("lost", "bigint"),
    "points": ("points", "bigint"),
    "goals_for": ("goalsFor", "bigint"),
    "goals_against": ("goalsAgainst", "bigint"),
    "goal_difference": ("goalDifference", "bigint"),
}


#: The type of the provider's tables that are kept.
OVERALL = "TOTAL"
LOAD = ("loaded_at", "run_id", "arrival")


def _with_arrival(raw: DataFrame) -> DataFrame:
    """RAW rows written before responses carried their place have none; the contract has it nullable."""
    return raw if "arrival" in raw.columns else raw.withColumn("arrival", F.lit(None).cast("string"))


def _newest_load() -> list[Column]:
    return [F.col(name).desc_nulls_first() for name in LOAD[:-1]] + [F.col(LOAD[-1]).desc_nulls_last()]


def stg_competitions(raw_competitions: DataFrame) -> DataFrame:
    typed = _with_arrival(raw_competitions).select(
        "competition_code", *fields("raw_json", COMPETITION_FIELDS), *LOAD
    )
    return latest_per_key(typed, ["competition_code"], _newest_load()).drop("run_id", "arrival")


def stg_teams(raw_teams: DataFrame) -> DataFrame:
    typed = _with_arrival(raw_teams).select(
        "competition_code", "season", field("raw_json", "id", "bigint").alias("team_id"),
        *fields("raw_json", TEAM_FIELDS), *LOAD,
    )
    return latest_per_key(typed, ["competition_code", "season", "team_id"], _newest_load()).drop("run_id", "arrival")


def stg_matches(raw_matches: DataFrame) -> DataFrame:
    typed = _with_arrival(raw_matches).select(
        "match_id", "competition_code", "season", *fields("raw_json", MATCH_FIELDS), *LOAD
    )
    return latest_per_key(typed, ["match_id"], _newest_load()).drop("run_id", "arrival")


def stg_standings(raw_standings: DataFrame) -> DataFrame:
    """The provider's own tables, one row per team; only the overall table is kept."""
    unit = ["competition_code", "season", "snapshot_date"]
    latest = latest_per_key(_with_arrival(raw_standings), unit, _newest_load())
    stages = latest.select(
        *unit, "loaded_at", F.explode(F.try_variant_get("raw_json", "$.standings", "array<variant>")).alias("entry")
    ).select(
        *unit,
        "loaded_at",
        field("entry", "stage").alias("stage"),
        field("entry", "type").alias("standing_type"),
        F.try_variant_get("entry", "$.table", "array<variant>").alias("team_table"),
    )
    return (
        stages.filter(F.col("standing_type") == OVERALL)
        .select(*unit, "loaded_at", "stage", "standing_type", F.explode("team_table").alias("team_row"))
        .select(*unit, "loaded_at", "stage", "standing_type", *fields("team_row", STANDING_FIELDS))
    )
