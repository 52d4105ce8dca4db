"""The dashboard's questions, as functions over the stored marts. Filters prune partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.functions.expressions import form_initials, ratio, season_label, signed
from leaguelake.sources.schemas import DEFAULT_COMPETITION


class NotFound(LookupError):
    """Nothing is stored for what was asked."""


def _unit(df: DataFrame, season: str, competition: str) -> DataFrame:
    return df.filter((F.col("season") == season) & (F.col("competition_code") == competition))


def _up(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def _down(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def parse_team_ids(text: str | None) -> list[int]:
    """'1, 2' -> [1, 2]; blanks are skipped."""
    return [int(part) for part in (text or "").split(",") if part.strip()]


def competitions(stg_competitions: DataFrame) -> DataFrame:
    return stg_competitions.select("competition_code", "competition_name", "area_name").orderBy(_up("competition_name"))


def seasons(dim_season: DataFrame, competition: str = DEFAULT_COMPETITION) -> DataFrame:
    return (
        dim_season.filter(F.col("competition_code") == competition)
        .select("season", "season_start_date", "season_end_date", "total_matchweeks")
        .orderBy(_down("season"))
    )


def default_season(dim_season: DataFrame) -> DataFrame:
    """The newest season of each competition and its label."""
    return dim_season.groupBy("competition_code").agg(F.max("season").alias("season")).select(
        "competition_code", "season", season_label(F.col("season")).alias("season_label")
    )


_TEAM_COLUMNS = ("team_id", "team_name", "team_short_name", "team_tla", "team_crest_url")


def teams(
    dim_team: DataFrame,
    stg_teams: DataFrame,
    league_table: DataFrame,
    competition: str = DEFAULT_COMPETITION,
    season: str | None = None,
) -> DataFrame:
    """Teams with a table row in that season or, without a season, ever seen in the competition."""
    if season:
        seen = _unit(league_table, season, competition)
    else:
        seen = stg_teams.filter(F.col("competition_code") == competition)
    return dim_team.select(*_TEAM_COLUMNS).join(seen.select("team_id"), "team_id", "left_semi").orderBy(_up("team_name"))


def league_table(mart: DataFrame, season: str, competition: str = DEFAULT_COMPETITION) -> DataFrame:
    return _unit(mart, season, competition).select(
        "team_id", "team_name", "team_crest_url", "league_position", "played_games", "won", "drawn", "lost",
        "goals_for", "goals_against", "goal_difference", "points", "points_per_game", "form_last_5",
    ).orderBy(_up("league_position"))


def existing_league_table(mart: DataFrame, season: str, competition: str = DEFAULT_COMPETITION) -> DataFrame:
    """The same table, refusing a season nothing is stored for."""
    table = league_table(mart, season, competition)
    if table.isEmpty():
        raise NotFound(f"no league table for {competition} season {season}")
    return table


def displayed_league_table(table: DataFrame) -> DataFrame:
    """As shown on the page: signed goal difference and form as letters."""
    return table.withColumn("goal_difference_shown", signed(F.col("goal_difference"))).withColumn(
        "form_shown", form_initials(F.col("form_last_5"))
    )


def of_teams(rows: DataFrame, team_ids: Sequence[int] | DataFrame) -> DataFrame:
    """The rows of the asked teams. Ids are a table joined by its measured size, never a list in the query;
    ids asked twice, unknown ones and nulls do no harm."""
    if not isinstance(team_ids, DataFrame):
        team_ids = rows.sparkSession.createDataFrame([(int(i),) for i in team_ids], "team_id bigint")
    return rows.join(team_ids.select("team_id"), "team_id", "left_semi").select(*rows.columns)


def progression(
    mart: DataFrame,
    dim_team: DataFrame,
    season: str,
    competition: str = DEFAULT_COMPETITION,
    team_ids: Sequence[int] | DataFrame | None = None,
) -> DataFrame:
    """Positions by matchweek, of the asked teams; without ids, or with an empty list, of all."""
    rows = _unit(mart, season, competition)
    if isinstance(team_ids, DataFrame) or team_ids:
        rows = of_teams(rows, team_ids)
    return (
        rows.join(dim_team.select("team_id", "team_name"), "team_id")
        .select("team_id", "team_name", "matchweek", "league_position", "points", "position_change")
        .orderBy(_up("team_id"), _up("matchweek"))
    )


def progression_matrix(progression_rows: DataFrame) -> DataFrame:
    """One row per matchweek, one column for each team of the unit holding its position."""
    names = progression_rows.select("team_name").distinct().orderBy("team_name")
    shown = [r.team_name for r in names.collect()]  # the teams of one competition and season
    return (
        progression_rows.groupBy("matchweek")
        .pivot("team_name", shown)
        .agg(F.first("league_position", ignorenulls=True))
        .orderBy(_up("matchweek"))
    )


def team_form(mart: DataFrame, team_id: int, season: str, competition: str = DEFAULT_COMPETITION) -> DataFrame:
    return (
        _unit(mart, season, competition)
        .filter(F.col("team_id") == team_id)
        .select(
            "match_id", "matchweek", "kickoff_utc", "result", "points", "ppg_last_5", "ppg_last_10", "form_last_5"
        )
        .orderBy(_up("kickoff_utc"), _up("match_id"))
    )


def home_away(mart: DataFrame, dim_team: DataFrame, season: str, competition: str = DEFAULT_COMPETITION) -> DataFrame:
    return (
        _unit(mart, season, competition)
        .join(dim_team.select("team_id", "team_name"), "team_id")
        .select(
            "team_id", "team_name",
            "home_played", "home_points", "home_ppg", "home_win_pct", "home_goal_difference",
            "away_played", "away_points", "away_ppg", "away_win_pct", "away_goal_difference",
        )
        .orderBy(_down("home_ppg"))
    )


def goal_analysis(
    mart: DataFrame, dim_team: DataFrame, season: str, competition: str = DEFAULT_COMPETITION
) -> DataFrame:
    return (
        _unit(mart, season, competition)
        .join(dim_team.select("team_id", "team_name"), "team_id")
        .select(
            "team_id", "team_name", "played", "goals_for", "goals_against",
            "goals_for_per_match", "goals_against_per_match",
            "clean_sheets", "clean_sheet_pct", "matches_failed_to_score", "failed_to_score_pct",
        )
        .orderBy(_down("goals_for"))
    )


def overview_kpis(mart_league_table: DataFrame) -> DataFrame:
    """Matches, goals, goals per match, leader and top scorer of every competition and season.

    Teams level on goals are taken in table order.
    """
    in_table_order = F.struct("league_position", "team_id")
    by_goals = F.struct(-F.col("goals_for"), F.col("league_position"), F.col("team_id"))
    totals = mart_league_table.groupBy("competition_code", "season").agg(
        F.sum("played_games").alias("team_games"),
        F.sum("goals_for").alias("total_goals"),
        F.min_by("team_name", in_table_order).alias("leader"),
        F.min_by("team_name", by_goals).alias("top_scorer"),
        F.max("goals_for").alias("top_scorer_goals"),
    )
    return totals.select(
        "competition_code", "season",
        (F.col("team_games") / 2).cast("double").alias("matches_played"),
        "total_goals",
        ratio(2 * F.col("total_goals"), F.col("team_games"), 2).alias("goals_per_match"),
        "leader", "top_scorer", "top_scorer_goals",
    )


def team_compare(
    mart_league_table: DataFrame,
    mart_home_away: DataFrame,
    mart_goals: DataFrame,
    teams_asked: DataFrame,
    season: str,
    competition: str = DEFAULT_COMPETITION,
) -> DataFrame:
    """Table, home/away and scoring figures side by side for each asked team_id."""

    def columns(mart: DataFrame, *names: str) -> DataFrame:
        return _unit(mart, season, competition).select("team_id", *names)

    return (
        teams_asked.select("team_id")
        .join(columns(mart_league_table, "team_name", "league_position", "points", "points_per_game", "goal_difference"),
              "team_id", "left")
        .join(columns(mart_home_away, "home_ppg", "away_ppg", "home_win_pct", "away_win_pct"), "team_id", "left")
        .join(columns(mart_goals, "goals_for", "goals_against", "clean_sheet_pct", "failed_to_score_pct"),
              "team_id", "left")
    )
