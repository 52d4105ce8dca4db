from __future__ import annotations

import pytest
from samples import rows

from leaguelake.plans import serving

TABLE = ("competition_code string, season string, team_id long, team_name string, team_crest_url string, "
         "league_position long, played_games long, won long, drawn long, lost long, goals_for long, goals_against long, "
         "goal_difference long, points long, points_per_game double, form_last_5 array<string>")


@pytest.fixture
def table(spark):
    def row(team, name, position, played, scored, difference, points, season="2023"):
        return ("PL", season, team, name, None, position, played, 0, 0, 0, scored, 0, difference, points, 1.5, ["WIN", "LOSS"])

    return spark.createDataFrame([
        row(1, "B", 2, 2, 7, 0, 3), row(2, "A", 1, 2, 7, 2, 6), row(3, "C", 3, 1, 1, -2, 0), row(1, "B", 1, 1, 0, 0, 1, "2022"),
    ], TABLE)


def test_team_ids_from_text():
    assert serving.parse_team_ids("1, 2,, 3") == [1, 2, 3]
    assert serving.parse_team_ids("") == serving.parse_team_ids(None) == []


def test_league_table_is_ordered_and_refuses_the_unknown(table):
    found = serving.existing_league_table(table, "2023")
    assert [r.team_id for r in found.collect()] == [2, 1, 3]
    with pytest.raises(serving.NotFound):
        serving.existing_league_table(table, "1999")
    shown = serving.displayed_league_table(found).select("goal_difference_shown", "form_shown").collect()
    assert [tuple(r) for r in shown] == [("+2", "WL"), ("0", "WL"), ("-2", "WL")]


def test_overview(table):
    assert rows(serving.overview_kpis(table)) == [
        ("PL", "2022", 0.5, 0, 0.0, "B", "B", 0),
        ("PL", "2023", 2.5, 15, 6.0, "A", "A", 7),
    ]


def test_teams_with_and_without_a_season(spark, table):
    names = "team_id long, team_name string, team_short_name string, team_tla string, team_crest_url string"
    dim = spark.createDataFrame([(n, name, None, None, None) for n, name in ((1, "B"), (2, "A"), (3, "C"), (4, "D"))], names)
    seen = spark.createDataFrame([("PL", 4), ("PL", 4), ("PL", 1), ("CL", 2)], "competition_code string, team_id long")
    assert [r.team_name for r in serving.teams(dim, seen, table).collect()] == ["B", "D"]
    assert [r.team_name for r in serving.teams(dim, seen, table, season="2023").collect()] == ["A", "B", "C"]


def test_progression_and_its_matrix(spark):
    mart = spark.createDataFrame(
        [("PL", "2023", t, w, p, 0, None) for t, w, p in ((1, 1, 1), (1, 2, 2), (2, 1, 2), (3, 2, 1))],
        "competition_code string, season string, team_id long, matchweek long, league_position long, points long, "
        "position_change long",
    )
    dim = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "team_id long, team_name string")
    whole = serving.progression(mart, dim, "2023")
    assert [(r.team_id, r.matchweek) for r in whole.collect()] == [(1, 1), (1, 2), (2, 1), (3, 2)]
    assert serving.progression(mart, dim, "2023", team_ids=[2]).count() == 1
    assert serving.progression(mart, dim, "2023", team_ids=[]).count() == 4
    matrix = serving.progression_matrix(whole)
    assert [tuple(r) for r in matrix.collect()] == [(1, 1, 2, None), (2, 2, None, 1)]


def test_team_compare_keeps_a_team_without_figures(spark, table):
    asked = spark.createDataFrame([(1,), (99,)], "team_id long")
    side = "competition_code string, season string, team_id long, home_ppg double, away_ppg double, home_win_pct double, away_win_pct double"
    goals = ("competition_code string, season string, team_id long, goals_for long, goals_against long, "
             "clean_sheet_pct double, failed_to_score_pct double")
    found = serving.team_compare(
        table, spark.createDataFrame([("PL", "2023", 1, 3.0, None, 100.0, None)], side),
        spark.createDataFrame([("PL", "2023", 1, 7, 0, 50.0, 0.0)], goals), asked, "2023",
    )
    assert rows(found, "team_id", "team_name", "points", "home_ppg", "goals_for") == [
        (1, "B", 3, 3.0, 7), (99, None, None, None, None)
    ]


def test_seasons_and_default(spark):
    dim = spark.createDataFrame(
        [("PL", "2022", None, None, 38), ("PL", "2023", None, None, 38), ("CL", "2021", None, None, 8)],
        "competition_code string, season string, season_start_date date, season_end_date date, total_matchweeks long",
    )
    assert [r.season for r in serving.seasons(dim).collect()] == ["2023", "2022"]
    assert rows(serving.default_season(dim)) == [("CL", "2021", "2021/22"), ("PL", "2023", "2023/24")]
