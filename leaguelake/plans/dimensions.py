"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.functions.expressions import is_weekend
from leaguelake.operators.latest import latest_per_key

# Fixed bounds of the calendar; the end day itself is left out.
CALENDAR_START, CALENDAR_END = "2023-01-01", "2029-12-31"


def dim_team(stg_teams: DataFrame) -> DataFrame:
    """One row per team, with the attributes of its newest season (a missing season counts as newest)."""
    newest = [
        F.col("season").desc_nulls_first(),
        F.col("loaded_at").desc_nulls_first(),
        F.col("competition_code").asc_nulls_last(),
    ]
    return latest_per_key(stg_teams, ["team_id"], newest).select(
        "team_id", "team_name", "team_short_name", "team_tla", "team_crest_url",
        "founded_year", "club_colors", "venue_name",
    )


def dim_season(stg_matches: DataFrame) -> DataFrame:
    """Match ids are unique in staging, so a plain count needs no second shuffle."""
    return stg_matches.groupBy("competition_code", "season").agg(
        F.min("kickoff_utc").cast("date").alias("season_start_date"),
        F.max("kickoff_utc").cast("date").alias("season_end_date"),
        F.max("matchweek").alias("total_matchweeks"),
        F.count("match_id").alias("total_matches"),
    )


def dim_matchweek(stg_matches: DataFrame) -> DataFrame:
    return (
        stg_matches.filter(F.col("matchweek").isNotNull())
        .groupBy("competition_code", "season", "matchweek")
        .agg(
            F.min("kickoff_utc").alias("matchweek_start_utc"),
            F.max("kickoff_utc").alias("matchweek_end_utc"),
            F.count("match_id").alias("matches_in_week"),
        )
    )


def dim_date(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END, matches: DataFrame | None = None
) -> DataFrame:
    """One row per day from start up to, not including, end; with matches, from their first kickoff day through the last."""
    if matches is None:
        bounds = spark.range(1).select(F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("end"))
    else:
        bounds = matches.agg(
            F.min("kickoff_utc").cast("date").alias("first"),
            F.date_add(F.max("kickoff_utc").cast("date"), 1).alias("end"),
        )
    day = F.col("date_day")
    return _spine(bounds).select(
        day.alias("date_key"),
        day,
        F.year(day).cast("long").alias("year"),
        F.month(day).cast("long").alias("month"),
        F.day(day).cast("long").alias("day_of_month"),
        F.dayname(day).alias("day_name"),
        F.quarter(day).cast("long").alias("quarter"),
        F.weekofyear(day).cast("long").alias("week_of_year"),
        is_weekend(day).alias("is_weekend"),
    )


def _spine(bounds: DataFrame) -> DataFrame:
    last = F.greatest(F.col("first"), F.date_sub("end", 1))
    days = F.sequence("first", last, F.expr("interval 1 day"))
    return bounds.select("end", F.explode(days).alias("date_day")).filter(F.col("date_day") < F.col("end"))
