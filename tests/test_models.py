"""Golden rows for the rules the models must keep."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from samples import EARLY, LATE, match, raw_matches, raw_standings, raw_teams, rows, standing

from leaguelake.functions import expressions as E
from leaguelake.plans import dimensions, facts, intermediate, marts, staging


def performance_of(spark, matches, **unit):
    return intermediate.match_team_performance(staging.stg_matches(raw_matches(spark, matches, **unit)))


def test_latest_load_wins_and_repeating_a_load_changes_nothing(spark):
    first = raw_matches(spark, [match(1, 1, "2023-08-11", 1, 2, status="TIMED")])
    second = raw_matches(spark, [match(1, 1, "2023-08-12", 1, 2, (2, 1))], run_id="r2", loaded_at=LATE)
    once = staging.stg_matches(first.unionByName(second))
    again = staging.stg_matches(first.unionByName(second).unionByName(second))
    assert rows(once, "match_id", "match_status", "kickoff_utc", "full_time_home_goals", "winner", "loaded_at") == [
        ("1", "FINISHED", datetime(2023, 8, 12, 15), 2, "HOME_TEAM", LATE)
    ]
    assert rows(once) == rows(again)


def test_one_load_time_is_settled_by_run_id(spark):
    a = raw_matches(spark, [match(1, 1, "2023-08-11", 1, 2, (0, 0))], run_id="a")
    b = raw_matches(spark, [match(1, 1, "2023-08-11", 1, 2, (1, 0))], run_id="b")
    assert rows(staging.stg_matches(a.unionByName(b)), "full_time_home_goals") == [(1,)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_kickoff_keeps_its_wall_clock(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        staged = staging.stg_matches(raw_matches(spark, [match(1, 1, "2023-03-12T02:30:00Z", 1, 2)]))
        assert rows(facts.fact_match(staged), "kickoff_utc", "match_date") == [
            (datetime(2023, 3, 12, 2, 30), date(2023, 3, 12))
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_bad_field_becomes_null(spark):
    odd = match(1, "one", "never", 1, 2)
    assert rows(staging.stg_matches(raw_matches(spark, [odd])), "matchweek", "kickoff_utc") == [(None, None)]


def test_two_rows_per_counted_match(spark):
    played = [
        match(1, 1, "2023-08-11", 1, 2, (2, 0)),
        match(2, 1, "2023-08-11", 3, 4, (0, 2), status="AWARDED"),
        match(3, 1, "2023-08-11", 5, 6, (1, 1), status="POSTPONED"),
        match(4, 1, "2023-08-11", 7, 8, (1, 1), winner=None),
        match(5, 1, "2023-08-11", 9, 10, (1, 1)),
    ]
    found = performance_of(spark, played)
    assert rows(found, "match_id", "team_id", "is_home", "goal_difference", "result", "points") == [
        ("1", 1, True, 2, "WIN", 3), ("1", 2, False, -2, "LOSS", 0),
        ("2", 3, True, -2, "LOSS", 0), ("2", 4, False, 2, "WIN", 3),
        ("4", 7, True, 0, "LOSS", 0), ("4", 8, False, 0, "LOSS", 0),
        ("5", 10, False, 0, "DRAW", 1), ("5", 9, True, 0, "DRAW", 1),
    ]


def test_unpivot_reads_once_and_does_not_shuffle(spark, tmp_path):
    staging.stg_matches(raw_matches(spark, [match(1, 1, "2023-08-11", 1, 2, (2, 0))])).write.parquet(str(tmp_path / "m"))
    found = intermediate.match_team_performance(spark.read.parquet(str(tmp_path / "m")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def progression_of(spark, matches, **unit):
    return intermediate.table_progression(performance_of(spark, matches, **unit))


def test_equal_kickoffs_follow_the_id_as_text(spark):
    same = [match(9, 2, "2023-08-11", 1, 2, (0, 1)), match(10, 1, "2023-08-11", 1, 3, (4, 0))]
    table = progression_of(spark, same).filter("team_id = 1")
    assert rows(table, "as_of_match_id", "played_games", "points", "goal_difference") == [
        ("10", 1, 3, 4), ("9", 2, 3, 3)
    ]


def test_running_record(spark):
    games = [
        match(1, 1, "2023-08-11", 1, 2, (2, 0)), match(2, 2, "2023-08-18", 2, 1, (1, 1)),
        match(3, 3, "2023-08-25", 1, 2, (0, 3)),
    ]
    table = progression_of(spark, games).filter("team_id = 1")
    assert rows(
        table, "played_games", "won", "drawn", "lost", "goals_for", "goals_against", "goal_difference", "points",
        "league_position",
    ) == [(1, 1, 0, 0, 2, 0, 2, 3, 1), (2, 1, 1, 0, 3, 1, 2, 4, 1), (3, 1, 1, 1, 3, 4, -1, 4, 2)]


def test_level_teams_share_a_position_and_leave_a_gap(spark):
    games = [match(1, 1, "2023-08-11", 1, 2, (2, 0)), match(2, 1, "2023-08-11", 3, 4, (2, 0))]
    assert rows(progression_of(spark, games), "team_id", "league_position") == [(1, 1), (2, 3), (3, 1), (4, 3)]


def test_postponed_round_keeps_its_label(spark):
    """Round 2 played after round 3: ranked under round 2, and the current row stays round 3."""
    games = [
        match(1, 1, "2023-08-11", 1, 2, (1, 0)), match(3, 3, "2023-08-25", 1, 2, (1, 0)),
        match(2, 2, "2023-09-30", 1, 2, (0, 1)),
    ]
    performance = performance_of(spark, games)
    snapshots = facts.fact_standing_snapshot(intermediate.table_progression(performance))
    assert rows(snapshots.filter("team_id = 1"), "matchweek", "played_games", "points") == [
        (1, 1, 3), (2, 3, 6), (3, 2, 6)
    ]
    teams = dimensions.dim_team(staging.stg_teams(raw_teams(spark, [{"id": 1, "name": "A"}, {"id": 2, "name": "B"}])))
    table = marts.mart_league_table(snapshots, teams, marts.mart_team_form(performance))
    assert rows(table.filter("team_id = 1"), "team_name", "played_games", "points", "points_per_game", "form_last_5") == [
        ("A", 2, 6, 3.0, ["WIN", "WIN", "LOSS"])
    ]


def test_one_season_text_in_two_competitions_stays_apart(spark):
    league = raw_matches(spark, [match(1, 1, "2023-08-11", 1, 2, (1, 0))])
    cup = raw_matches(spark, [match(2, 1, "2023-08-12", 1, 2, (0, 1), stage="GROUP_STAGE")], competition="CL")
    performance = intermediate.match_team_performance(staging.stg_matches(league.unionByName(cup)))
    table = intermediate.table_progression(performance)
    assert rows(table, "competition_code", "team_id", "played_games", "points", "league_position") == [
        ("CL", 1, 1, 0, 2), ("CL", 2, 1, 3, 1), ("PL", 1, 1, 3, 1), ("PL", 2, 1, 0, 2)
    ]


def test_knockout_counts_for_form_but_not_for_the_table(spark):
    games = [
        match(1, 1, "2023-09-01", 1, 2, (1, 0), stage="LEAGUE_STAGE"),
        match(2, None, "2024-02-01", 1, 2, (0, 2), stage="LAST_16"),
    ]
    performance = performance_of(spark, games, competition="CL")
    assert rows(intermediate.table_progression(performance), "as_of_match_id") == [("1",), ("1",)]
    form = marts.mart_team_form(performance).filter("team_id = 1")
    assert rows(form, "match_id", "matches_in_last_5", "form_last_5") == [("1", 1, ["WIN"]), ("2", 2, ["WIN", "LOSS"])]
    goals = marts.mart_goal_analysis(performance).filter("team_id = 1")
    assert rows(goals, "played", "goals_for", "goals_against") == [(2, 1, 2)]


def test_rolling_form_over_twelve_games(spark):
    games = [match(100 + i, i + 1, f"2023-08-{i + 1:02d}", 1, 2, (i % 3, 1)) for i in range(12)]
    form = marts.mart_team_form(performance_of(spark, games)).filter("team_id = 1 and matchweek in (3, 12)")
    assert rows(
        form, "matchweek", "matches_in_last_5", "points_last_5", "ppg_last_5", "goals_for_last_5", "goals_against_last_5",
        "matches_in_last_10", "points_last_10", "ppg_last_10", "goals_for_last_10", "goals_against_last_10",
    ) == [(12, 5, 8, 1.6, 6, 5, 10, 15, 1.5, 11, 10), (3, 3, 4, 1.33, 3, 3, 3, 4, 1.33, 3, 3)]
    last = form.filter("matchweek = 12").select("form_last_5").first()[0]
    assert last == ["DRAW", "WIN", "LOSS", "DRAW", "WIN"]


def test_progression_deltas(spark):
    games = [match(1, 1, "2023-08-11", 1, 2, (0, 1)), match(2, 2, "2023-08-18", 1, 2, (5, 0))]
    found = marts.mart_league_progression(facts.fact_standing_snapshot(progression_of(spark, games)))
    assert rows(
        found.filter("team_id = 1"), "matchweek", "previous_matchweek_position", "position_change",
        "points_gained_this_matchweek",
    ) == [(1, None, None, 0), (2, 2, 1, 3)]
    assert rows(found.filter("team_id = 2 and matchweek = 1"), "position_change", "points_gained_this_matchweek") == [
        (None, 3)
    ]


def test_side_without_games_has_no_ratio(spark):
    found = marts.mart_home_away_performance(performance_of(spark, [match(1, 1, "2023-08-11", 1, 2, (2, 0))]))
    assert rows(found, "team_id", "home_played", "home_ppg", "home_win_pct", "away_ppg", "away_goal_difference") == [
        (1, 1, 3.0, 100.0, None, 0), (2, 0, None, None, 0.0, -2)
    ]


def test_goal_profile(spark):
    games = [match(1, 1, "2023-08-11", 1, 2, (2, 0)), match(2, 2, "2023-08-12", 2, 1, (0, 0)),
             match(3, 3, "2023-08-13", 1, 2, (2, 1))]
    found = marts.mart_goal_analysis(performance_of(spark, games)).filter("team_id = 1")
    assert rows(found) == [("PL", 1, "2023", 3, 4, 1, 1.33, 0.33, 2, 66.7, 1, 33.3)]


@pytest.mark.parametrize(("top", "bottom", "digits", "scale", "expected"), [
    (29, 40, 2, 1, 0.73), (29, 200, 2, 1, 0.15), (1, 8, 2, 1, 0.13), (1, 0, 2, 1, None), (1, 3, 1, 100, 33.3),
    (1, 16, 1, 100, 6.3), (-29, 200, 2, 1, -0.15),
])
def test_ratio_rounds_half_away_from_zero(spark, top, bottom, digits, scale, expected):
    df = spark.createDataFrame([(top, bottom)], "n long, d long")
    assert df.select(E.ratio(F.col("n"), F.col("d"), digits, scale)).first()[0] == expected


def test_dim_team_takes_the_newest_season_and_a_missing_one_first(spark):
    old = raw_teams(spark, [{"id": 1, "name": "Old"}, {"id": 2, "name": "Old"}], season="2022")
    new = raw_teams(spark, [{"id": 1, "name": "New", "venue": "Park"}], season="2023")
    unknown = raw_teams(spark, [{"id": 2, "name": "Undated"}], season=None)
    found = dimensions.dim_team(staging.stg_teams(old.unionByName(new).unionByName(unknown)))
    assert rows(found, "team_id", "team_name", "venue_name") == [(1, "New", "Park"), (2, "Undated", None)]


def test_rollups_count_every_status_and_skip_missing_matchweeks(spark):
    games = [match(1, 1, "2023-08-11", 1, 2, (2, 0)), match(2, 1, "2023-08-14", 3, 4, status="TIMED"),
             match(3, None, "2024-05-01", 1, 2, status="SCHEDULED", stage="FINAL")]
    staged = staging.stg_matches(raw_matches(spark, games))
    assert rows(dimensions.dim_season(staged)) == [("PL", "2023", date(2023, 8, 11), date(2024, 5, 1), 1, 3)]
    assert rows(dimensions.dim_matchweek(staged)) == [
        ("PL", "2023", 1, datetime(2023, 8, 11, 15), datetime(2023, 8, 14, 15), 2)
    ]


def test_calendar(spark):
    days = dimensions.dim_date(spark)
    assert days.count() == 2556
    assert days.agg(F.min("date_key"), F.max("date_key")).first() == (date(2023, 1, 1), date(2029, 12, 30))
    assert rows(days.filter("date_key = '2023-01-01'")) == [
        (date(2023, 1, 1), date(2023, 1, 1), 2023, 1, 1, "Sun", 1, 52, True)
    ]
    assert days.filter("is_weekend and day_name not in ('Sat', 'Sun')").count() == 0
    assert dimensions.dim_date(spark, "2023-01-01", "2023-01-01").count() == 0


def test_standings_keep_the_overall_table_of_the_latest_load(spark):
    def payload(points):
        return {"standings": [
            {"stage": "REGULAR_SEASON", "type": "TOTAL", "table": [standing(1, 65, 38, points, 62)]},
            {"stage": "REGULAR_SEASON", "type": "HOME", "table": [standing(1, 65, 19, 50, 30)]},
            {"stage": "REGULAR_SEASON", "type": "TOTAL", "table": []},
        ]}

    raw = raw_standings(spark, payload(90)).unionByName(raw_standings(spark, payload(91), run_id="r2", loaded_at=LATE))
    raw = raw.unionByName(raw_standings(spark, payload(80), day=date(2023, 12, 1)))
    raw = raw.unionByName(raw_standings(spark, {"standings": []}, season="2022"))
    assert rows(staging.stg_standings(raw), "season", "snapshot_date", "api_position", "team_id", "points", "loaded_at") == [
        ("2023", date(2023, 12, 1), 1, 65, 80, EARLY), ("2023", date(2024, 1, 1), 1, 65, 91, LATE)
    ]


def test_small_expressions(spark):
    one = spark.range(1)
    assert one.select(E.season_label(F.lit("2023"))).first()[0] == "2023/24"
    assert one.select(E.season_label(F.lit("1999"))).first()[0] == "1999/00"
    form = F.array(F.lit("WIN"), F.lit("DRAW"), F.lit("LOSS"), F.lit("?"))
    assert one.select(E.form_initials(form)).first()[0] == "WDLL"
    assert [one.select(E.signed(F.lit(n))).first()[0] for n in (3, 0, -2)] == ["+3", "0", "-2"]
    assert one.select(F.length(E.bounded_message(F.lit("x" * 5000)))).first()[0] == 4000
    days = [("2026-05-01", 2025), ("2026-06-30", 2025), ("2026-07-01", 2026), ("2026-08-01", 2026)]
    for day, year in days:
        assert one.select(E.season_start_year(F.lit(day).cast("date"))).first()[0] == year
