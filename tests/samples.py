"""Small payloads and RAW tables for the tests."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import functions as F

EARLY, LATE = datetime(2024, 1, 1, 6), datetime(2024, 1, 2, 6)


def match(number, week, kickoff, home, away, score=None, status="FINISHED", stage="REGULAR_SEASON", winner="by score"):
    """kickoff is a day or a full timestamp; score is (home, away) or None."""
    home_goals, away_goals = score or (None, None)
    if winner == "by score":
        winner = None
        if score:
            winner = "HOME_TEAM" if home_goals > away_goals else "AWAY_TEAM" if home_goals < away_goals else "DRAW"
    return {
        "id": number,
        "matchday": week,
        "utcDate": kickoff if "T" in kickoff else f"{kickoff}T15:00:00Z",
        "status": status,
        "stage": stage,
        "homeTeam": {"id": home, "name": f"Team {home}"},
        "awayTeam": {"id": away, "name": f"Team {away}"},
        "score": {
            "winner": winner,
            "fullTime": {"home": home_goals, "away": away_goals},
            "halfTime": {"home": None, "away": None},
        },
    }


def raw_matches(spark, matches, competition="PL", season="2023", run_id="r1", loaded_at=EARLY):
    rows = [
        (competition, season, str(m["matchday"]), str(m["id"]), run_id, "test", loaded_at, json.dumps(m)) for m in matches
    ]
    return _with_variant(spark, rows, "competition_code string, season string, matchweek string, match_id string, "
                                      "run_id string, source string, loaded_at timestamp_ntz, raw_json string")


def raw_teams(spark, teams, competition="PL", season="2023", run_id="r1", loaded_at=EARLY):
    rows = [(competition, season, run_id, "test", loaded_at, json.dumps(t)) for t in teams]
    return _with_variant(spark, rows, "competition_code string, season string, run_id string, source string, "
                                      "loaded_at timestamp_ntz, raw_json string")


def raw_standings(spark, payload, competition="PL", season="2023", day=date(2024, 1, 1), run_id="r1", loaded_at=EARLY):
    rows = [(competition, season, day, run_id, "test", loaded_at, json.dumps(payload))]
    return _with_variant(spark, rows, "competition_code string, season string, snapshot_date date, run_id string, "
                                      "source string, loaded_at timestamp_ntz, raw_json string")


def _with_variant(spark, rows, schema):
    return spark.createDataFrame(rows, schema).withColumn("raw_json", F.parse_json("raw_json"))


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def standing(position, team, played, points, difference, **more):
    return {
        "position": position, "team": {"id": team, "name": f"Team {team}"}, "playedGames": played, "won": 0, "draw": 0,
        "lost": 0, "points": points, "goalsFor": 0, "goalsAgainst": 0, "goalDifference": difference, **more,
    }
