"""Facts of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fact_match(stg_matches: DataFrame) -> DataFrame:
    home, away = F.col("full_time_home_goals"), F.col("full_time_away_goals")
    return stg_matches.select(
        "match_id", "competition_code", "season", "matchweek", "kickoff_utc",
        F.col("kickoff_utc").cast("date").alias("match_date"),
        "match_status", "match_stage",
        "home_team_id", "home_team_name", "away_team_id", "away_team_name",
        "full_time_home_goals", "full_time_away_goals",
        (home + away).alias("total_goals"),
        (home - away).alias("goal_difference_home_minus_away"),
        "half_time_home_goals", "half_time_away_goals", "winner",
    )


def fact_team_match(performance: DataFrame) -> DataFrame:
    """Every stage, knockout matches included."""
    return performance.select(
        "match_id", "competition_code", "season", "matchweek", "match_stage", "kickoff_utc",
        F.col("kickoff_utc").cast("date").alias("match_date"),
        "team_id", "opponent_team_id", "is_home",
        "goals_for", "goals_against", "goal_difference", "result", "points",
    )


def fact_standing_snapshot(progression: DataFrame) -> DataFrame:
    return progression.select(
        "competition_code", "team_id", "season",
        F.col("as_of_matchweek").alias("matchweek"),
        "as_of_match_id", "as_of_kickoff_utc", "league_position",
        "played_games", "won", "drawn", "lost", "goals_for", "goals_against", "goal_difference", "points",
    )
