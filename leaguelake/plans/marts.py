"""Analytics marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.functions.expressions import count_when, per_game, percentage, sum_when
from leaguelake.operators.latest import latest_per_key
from leaguelake.operators.ordered import month_of, range_of, rolling
from leaguelake.plans.intermediate import TEAM_SEASON, by_kickoff


#: Matchweeks that share a piece of a season.
WEEKS_OF_PIECE = 8


def mart_team_form(performance: DataFrame) -> DataFrame:
    """Form over the last 5 and 10 matches as of each match, knockout matches included."""
    frames = {}
    for span in (5, 10):
        back = 1 - span
        frames[f"matches_in_last_{span}"] = lambda w, b=back: F.count(F.lit(1)).over(w.rowsBetween(b, 0))
        for column in ("points", "goals_for", "goals_against"):
            frames[f"{column}_last_{span}"] = lambda w, b=back, c=column: F.sum(c).over(w.rowsBetween(b, 0))
    frames["form_last_5"] = lambda w: F.collect_list("result").over(w.rowsBetween(-4, 0))

    played = performance.select(
        "match_id", *TEAM_SEASON, "matchweek", "kickoff_utc", "result", "points", "goals_for", "goals_against"
    )
    return rolling(played, TEAM_SEASON, by_kickoff(), month_of("kickoff_utc"), 9, frames).select(
        "match_id", *TEAM_SEASON, "matchweek", "kickoff_utc", "result", "points",
        "matches_in_last_5",
        "points_last_5",
        per_game("points_last_5", "matches_in_last_5").alias("ppg_last_5"),
        "goals_for_last_5",
        "goals_against_last_5",
        "form_last_5",
        "matches_in_last_10",
        "points_last_10",
        per_game("points_last_10", "matches_in_last_10").alias("ppg_last_10"),
        "goals_for_last_10",
        "goals_against_last_10",
    )


def mart_league_table(snapshots: DataFrame, teams: DataFrame, form: DataFrame) -> DataFrame:
    """The standing of each team at its highest matchweek, with its latest form.

    Highest matchweek, not latest kickoff: a postponed round played late shows once a higher
    matchweek is played. Sorting is left to whoever reads the table.
    """
    current = latest_per_key(
        snapshots, TEAM_SEASON, [F.col("matchweek").desc_nulls_first(), F.col("as_of_match_id").desc_nulls_first()]
    )
    latest_form = latest_per_key(
        form.select(*TEAM_SEASON, "kickoff_utc", "match_id", "form_last_5"),
        TEAM_SEASON,
        [F.col("kickoff_utc").desc_nulls_first(), F.col("match_id").desc_nulls_first()],
    ).select(*TEAM_SEASON, "form_last_5")
    named = teams.select("team_id", "team_name", "team_crest_url")
    return (
        current.join(latest_form, TEAM_SEASON, "left")
        .join(named, "team_id")
        .select(
            "competition_code", "team_id", "team_name", "team_crest_url", "season",
            "league_position", "played_games", "won", "drawn", "lost",
            "goals_for", "goals_against", "goal_difference", "points",
            per_game("points", "played_games").alias("points_per_game"),
            "form_last_5",
        )
    )


def mart_league_progression(snapshots: DataFrame) -> DataFrame:
    """The table after every matchweek, with the change since the team's previous one."""
    by_week = [F.col("matchweek").asc_nulls_last(), F.col("as_of_match_id").asc_nulls_last()]
    measures = [
        "league_position", "played_games", "won", "drawn", "lost",
        "goals_for", "goals_against", "goal_difference", "points",
    ]
    weeks = snapshots.select(*TEAM_SEASON, "matchweek", "as_of_match_id", *measures)
    lagged = rolling(
        weeks,
        TEAM_SEASON,
        by_week,
        range_of("matchweek", WEEKS_OF_PIECE),
        1,
        {
            "previous_matchweek_position": lambda w: F.lag("league_position").over(w),
            "_previous_points": lambda w: F.lag("points").over(w),
        },
    )
    return lagged.select(
        *TEAM_SEASON, "matchweek", *measures,
        "previous_matchweek_position",
        (F.col("previous_matchweek_position") - F.col("league_position")).alias("position_change"),
        (F.col("points") - F.coalesce("_previous_points", F.lit(0))).alias("points_gained_this_matchweek"),
    )


def mart_home_away_performance(performance: DataFrame) -> DataFrame:
    sums, shown = [], []
    for side, here in (("home", F.col("is_home")), ("away", ~F.col("is_home"))):
        sums += [
            count_when(here).alias(f"{side}_played"),
            sum_when(here, "points").alias(f"{side}_points"),
            count_when(here & (F.col("result") == "WIN")).alias(f"{side}_wins"),
            count_when(here & (F.col("result") == "DRAW")).alias(f"{side}_draws"),
            count_when(here & (F.col("result") == "LOSS")).alias(f"{side}_losses"),
            sum_when(here, "goals_for").alias(f"{side}_goals_for"),
            sum_when(here, "goals_against").alias(f"{side}_goals_against"),
        ]
        shown += [
            *[f"{side}_{name}" for name in ("played", "wins", "draws", "losses", "points")],
            per_game(f"{side}_points", f"{side}_played").alias(f"{side}_ppg"),
            f"{side}_goals_for",
            f"{side}_goals_against",
            (F.col(f"{side}_goals_for") - F.col(f"{side}_goals_against")).alias(f"{side}_goal_difference"),
            percentage(F.col(f"{side}_wins"), F.col(f"{side}_played")).alias(f"{side}_win_pct"),
        ]
    return performance.groupBy(*TEAM_SEASON).agg(*sums).select(*TEAM_SEASON, *shown)


def mart_goal_analysis(performance: DataFrame) -> DataFrame:
    totals = performance.groupBy(*TEAM_SEASON).agg(
        F.count(F.lit(1)).alias("played"),
        F.sum("goals_for").alias("goals_for"),
        F.sum("goals_against").alias("goals_against"),
        count_when(F.col("goals_against") == 0).alias("clean_sheets"),
        count_when(F.col("goals_for") == 0).alias("matches_failed_to_score"),
    )
    return totals.select(
        *TEAM_SEASON, "played", "goals_for", "goals_against",
        per_game("goals_for", "played").alias("goals_for_per_match"),
        per_game("goals_against", "played").alias("goals_against_per_match"),
        "clean_sheets",
        percentage(F.col("clean_sheets"), F.col("played")).alias("clean_sheet_pct"),
        "matches_failed_to_score",
        percentage(F.col("matches_failed_to_score"), F.col("played")).alias("failed_to_score_pct"),
    )
