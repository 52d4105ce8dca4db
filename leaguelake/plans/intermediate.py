"""Team-perspective results and the table derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.functions.expressions import one_if, points_of, result_of
from leaguelake.operators.ordered import month_of, rank_descending, running_totals
from leaguelake.sources.schemas import COUNTED_STATUSES, TABLE_STAGES
from leaguelake.sources.store import cut, let_go

TEAM_SEASON = ["competition_code", "team_id", "season"]


def by_kickoff() -> list[Column]:
    """Chronological; equal kickoffs by match_id as text ('10' before '9')."""
    return [F.col("kickoff_utc").asc_nulls_last(), F.col("match_id").asc_nulls_last()]


def match_team_performance(stg_matches: DataFrame) -> DataFrame:
    """Two rows per counted match, one for each side, from a single scan."""

    def side(is_home: bool) -> Column:
        us, them = ("home", "away") if is_home else ("away", "home")
        return F.struct(
            F.col(f"{us}_team_id").alias("team_id"),
            F.col(f"{them}_team_id").alias("opponent_team_id"),
            F.lit(is_home).alias("is_home"),
            F.col(f"full_time_{us}_goals").alias("goals_for"),
            F.col(f"full_time_{them}_goals").alias("goals_against"),
        )

    result = result_of(F.col("is_home"), F.col("winner"))
    return (
        stg_matches.filter(F.col("match_status").isin(*COUNTED_STATUSES))
        .select(
            "match_id", "competition_code", "season", "matchweek", "match_stage", "kickoff_utc", "winner",
            F.inline(F.array(side(True), side(False))),
        )
        .withColumn("result", result)
        .select(
            "match_id", "competition_code", "season", "matchweek", "match_stage", "kickoff_utc",
            "team_id", "opponent_team_id", "is_home", "goals_for", "goals_against",
            (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
            "result",
            points_of(F.col("result")).alias("points"),
        )
    )


def table_progression(performance: DataFrame) -> DataFrame:
    """Every team's record after each of its table matches, with its rank in that matchweek.

    The rank compares rows carrying one and the same matchweek label, whenever they were played. Ranking
    reads the records several times, so they are written down first: the totals are computed once.
    """
    eligible = performance.filter(F.col("match_stage").isin(*TABLE_STAGES)).select(
        *TEAM_SEASON, "match_id", "matchweek", "kickoff_utc", "result",
        F.col("goals_for").alias("scored"), F.col("goals_against").alias("conceded"),
        F.col("points").alias("earned"),
    )
    totals = running_totals(
        eligible,
        TEAM_SEASON,
        by_kickoff(),
        month_of("kickoff_utc"),
        {
            "played_games": F.lit(1),
            "won": one_if(F.col("result") == "WIN"),
            "drawn": one_if(F.col("result") == "DRAW"),
            "lost": one_if(F.col("result") == "LOSS"),
            "goals_for": F.col("scored"),
            "goals_against": F.col("conceded"),
            "points": F.col("earned"),
        },
    ).withColumn("goal_difference", F.col("goals_for") - F.col("goals_against"))
    records = totals.select(
        *TEAM_SEASON, "match_id", "matchweek", "kickoff_utc", "played_games", "won", "drawn", "lost",
        "goals_for", "goals_against", "goal_difference", "points",
    )
    written = cut(records, "records")
    let_go(performance.sparkSession)
    ranked = rank_descending(
        written,
        ["competition_code", "season", "matchweek"],
        ["points", "goal_difference", "goals_for"],
        "league_position",
    )
    return ranked.select(
        *TEAM_SEASON,
        F.col("match_id").alias("as_of_match_id"),
        F.col("matchweek").alias("as_of_matchweek"),
        F.col("kickoff_utc").alias("as_of_kickoff_utc"),
        "played_games", "won", "drawn", "lost", "goals_for", "goals_against", "goal_difference", "points",
        "league_position",
    )
