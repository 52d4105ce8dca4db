"""DuckDB SQL for the registered queries.

Every statement starts from the given tables; none of it goes through payloads, stored tables or
any code of the package. Ratios are rounded half up in integers, null order is always spelled out.
"""

from __future__ import annotations

# ---- the feed, straight from orders -------------------------------------------------------------

MATCHES = """
keyed AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate AS kickoff_utc,
         'C' || substr(o_orderpriority, 1, 1) AS competition_code,
         CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS VARCHAR) AS season
  FROM orders),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY competition_code, season ORDER BY kickoff_utc, o_orderkey) - 1 AS n
  FROM keyed),
rounds AS (SELECT *, n // 10 AS rd, n % 10 AS k FROM placed),
paired AS (
  SELECT *,
         CASE WHEN k = 0 THEN 19 ELSE (rd + k) % 19 END AS ta,
         CASE WHEN k = 0 THEN rd % 19 ELSE (rd - k + 19) % 19 END AS tb,
         CASE WHEN kickoff_utc >= TIMESTAMP '2001-03-01 00:00:00' THEN 'TIMED'
              WHEN o_orderkey % 50 = 0 THEN 'AWARDED'
              WHEN o_orderkey % 97 = 0 THEN 'POSTPONED'
              ELSE 'FINISHED' END AS match_status
  FROM rounds),
scored AS (
  SELECT *, match_status IN ('FINISHED', 'AWARDED') AS counted,
         CAST(floor(o_totalprice) AS BIGINT) % 5 AS gh, (3 * o_orderkey + o_custkey) % 4 AS ga
  FROM paired),
matches AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS match_id, o_orderkey, competition_code, season,
         CAST(rd + 1 AS BIGINT) AS matchweek, kickoff_utc, match_status,
         CASE WHEN competition_code <> 'C2' THEN 'REGULAR_SEASON'
              WHEN rd % 6 = 5 THEN 'LAST_16' ELSE 'GROUP_STAGE' END AS match_stage,
         CAST(CASE WHEN rd % 2 = 0 THEN ta ELSE tb END AS BIGINT) AS home_team_id,
         CAST(CASE WHEN rd % 2 = 0 THEN tb ELSE ta END AS BIGINT) AS away_team_id,
         CASE WHEN counted AND gh > ga THEN 'HOME_TEAM' WHEN counted AND gh < ga THEN 'AWAY_TEAM'
              WHEN counted THEN 'DRAW' END AS winner,
         CAST(CASE WHEN counted THEN gh END AS BIGINT) AS hg,
         CAST(CASE WHEN counted THEN ga END AS BIGINT) AS ag
  FROM scored)"""

PERFORMANCE = MATCHES + """,
sides AS (
  SELECT match_id, competition_code, season, matchweek, match_stage, kickoff_utc,
         home_team_id AS team_id, away_team_id AS opponent_team_id, TRUE AS is_home,
         hg AS goals_for, ag AS goals_against, winner
  FROM matches WHERE match_status IN ('FINISHED', 'AWARDED')
  UNION ALL
  SELECT match_id, competition_code, season, matchweek, match_stage, kickoff_utc,
         away_team_id, home_team_id, FALSE, ag, hg, winner
  FROM matches WHERE match_status IN ('FINISHED', 'AWARDED')),
performance AS (
  SELECT match_id, competition_code, season, matchweek, match_stage, kickoff_utc, team_id, opponent_team_id,
         is_home, goals_for, goals_against, goals_for - goals_against AS goal_difference,
         CASE WHEN goals_for > goals_against THEN 'WIN' WHEN goals_for = goals_against THEN 'DRAW'
              ELSE 'LOSS' END AS result,
         CAST(CASE WHEN goals_for > goals_against THEN 3 WHEN goals_for = goals_against THEN 1
              ELSE 0 END AS BIGINT) AS points
  FROM sides)"""

SNAPSHOTS = PERFORMANCE + """,
eligible AS (
  SELECT * FROM performance WHERE match_stage IN ('REGULAR_SEASON', 'LEAGUE_STAGE', 'GROUP_STAGE')),
running AS (
  SELECT competition_code, team_id, season, match_id, matchweek, kickoff_utc,
         CAST(row_number() OVER w AS BIGINT) AS played_games,
         CAST(sum(CASE WHEN result = 'WIN' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS won,
         CAST(sum(CASE WHEN result = 'DRAW' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS drawn,
         CAST(sum(CASE WHEN result = 'LOSS' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS lost,
         CAST(sum(goals_for) OVER w AS BIGINT) AS goals_for,
         CAST(sum(goals_against) OVER w AS BIGINT) AS goals_against,
         CAST(sum(points) OVER w AS BIGINT) AS points
  FROM eligible
  WINDOW w AS (PARTITION BY competition_code, team_id, season ORDER BY kickoff_utc NULLS LAST, match_id NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
progression AS (
  SELECT competition_code, team_id, season, match_id AS as_of_match_id, matchweek AS as_of_matchweek,
         kickoff_utc AS as_of_kickoff_utc, played_games, won, drawn, lost, goals_for, goals_against,
         goals_for - goals_against AS goal_difference, points,
         CAST(rank() OVER (PARTITION BY competition_code, season, matchweek
              ORDER BY points DESC NULLS FIRST, goals_for - goals_against DESC NULLS FIRST,
                       goals_for DESC NULLS FIRST) AS BIGINT) AS league_position
  FROM running),
snapshots AS (
  SELECT competition_code, team_id, season, as_of_matchweek AS matchweek, as_of_match_id, as_of_kickoff_utc,
         league_position, played_games, won, drawn, lost, goals_for, goals_against, goal_difference, points
  FROM progression)"""


def _half_up(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator rounded half up in integers, for a numerator of zero or more."""
    scale = 10**digits
    return (
        f"CAST(CASE WHEN {denominator} = 0 THEN NULL ELSE "
        f"(2 * {scale} * ({numerator}) + {denominator}) // (2 * {denominator}) END AS DOUBLE) / {scale}.0"
    )


def _pct(numerator: str, denominator: str) -> str:
    return _half_up(f"100 * ({numerator})", denominator, 1)


FORM = PERFORMANCE + f""",
framed AS (
  SELECT match_id, competition_code, team_id, season, matchweek, kickoff_utc, result, points,
         CAST(count(*) OVER w5 AS BIGINT) AS matches_in_last_5,
         CAST(sum(points) OVER w5 AS BIGINT) AS points_last_5,
         CAST(sum(goals_for) OVER w5 AS BIGINT) AS goals_for_last_5,
         CAST(sum(goals_against) OVER w5 AS BIGINT) AS goals_against_last_5,
         array_to_string(array_agg(result) OVER w5, ',') AS form_last_5,
         CAST(count(*) OVER w10 AS BIGINT) AS matches_in_last_10,
         CAST(sum(points) OVER w10 AS BIGINT) AS points_last_10,
         CAST(sum(goals_for) OVER w10 AS BIGINT) AS goals_for_last_10,
         CAST(sum(goals_against) OVER w10 AS BIGINT) AS goals_against_last_10
  FROM performance
  WINDOW w5 AS (PARTITION BY competition_code, team_id, season ORDER BY kickoff_utc NULLS LAST, match_id NULLS LAST
                ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
         w10 AS (PARTITION BY competition_code, team_id, season ORDER BY kickoff_utc NULLS LAST, match_id NULLS LAST
                 ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
form AS (
  SELECT match_id, competition_code, team_id, season, matchweek, kickoff_utc, result, points,
         matches_in_last_5, points_last_5, {_half_up('points_last_5', 'matches_in_last_5', 2)} AS ppg_last_5,
         goals_for_last_5, goals_against_last_5, form_last_5,
         matches_in_last_10, points_last_10, {_half_up('points_last_10', 'matches_in_last_10', 2)} AS ppg_last_10,
         goals_for_last_10, goals_against_last_10
  FROM framed)"""

TEAM_NAME = "'Team ' || lpad(CAST({id} AS VARCHAR), 2, '0')"
TEAMS = """units AS (SELECT DISTINCT competition_code, season FROM matches),
team_rows AS (
  SELECT competition_code, season, CAST(t.id AS BIGINT) AS team_id, lpad(CAST(t.id AS VARCHAR), 2, '0') AS nn
  FROM units, range(20) AS t(id)),
stg_teams AS (
  SELECT competition_code, season, team_id, 'Team ' || nn AS team_name, 'T' || nn AS team_short_name,
         'T' || nn AS team_tla, 'crests/' || nn || '.png' AS team_crest_url, 1900 + team_id AS founded_year,
         'Red / White' AS club_colors, 'Ground ' || nn || ' ' || season AS venue_name,
         TIMESTAMP '2001-08-02 18:00:00' AS loaded_at
  FROM team_rows),
dim_team AS (
  SELECT team_id, team_name, team_short_name, team_tla, team_crest_url, founded_year, club_colors,
         'Ground ' || substr(team_short_name, 2) || ' ' || max(season) AS venue_name
  FROM stg_teams GROUP BY ALL)""".replace(
    "FROM stg_teams GROUP BY ALL",
    "FROM stg_teams GROUP BY team_id, team_name, team_short_name, team_tla, team_crest_url, founded_year, club_colors",
)

TABLE = FORM + ",\n" + SNAPSHOTS.split("FROM sides)", 1)[1].lstrip(",\n") + ",\n" + TEAMS + f""",
newest_snapshot AS (
  SELECT *, row_number() OVER (PARTITION BY competition_code, team_id, season ORDER BY matchweek DESC NULLS FIRST) AS rn
  FROM snapshots),
newest_form AS (
  SELECT *, row_number() OVER (PARTITION BY competition_code, team_id, season
                               ORDER BY kickoff_utc DESC NULLS FIRST, match_id DESC NULLS FIRST) AS rn
  FROM form),
league_table AS (
  SELECT s.competition_code, s.team_id, t.team_name, t.team_crest_url, s.season, s.league_position, s.played_games,
         s.won, s.drawn, s.lost, s.goals_for, s.goals_against, s.goal_difference, s.points,
         {_half_up('s.points', 's.played_games', 2)} AS points_per_game, f.form_last_5
  FROM newest_snapshot s
  JOIN dim_team t ON t.team_id = s.team_id
  LEFT JOIN newest_form f ON f.competition_code = s.competition_code AND f.team_id = s.team_id
       AND f.season = s.season AND f.rn = 1
  WHERE s.rn = 1)"""

LEAGUE_PROGRESSION = SNAPSHOTS + """,
lagged AS (
  SELECT *, lag(league_position) OVER w AS previous_matchweek_position, lag(points) OVER w AS previous_points
  FROM snapshots
  WINDOW w AS (PARTITION BY competition_code, team_id, season ORDER BY matchweek NULLS LAST)),
league_progression AS (
  SELECT competition_code, team_id, season, matchweek, league_position, played_games, won, drawn, lost, goals_for,
         goals_against, goal_difference, points, previous_matchweek_position,
         previous_matchweek_position - league_position AS position_change,
         points - coalesce(previous_points, 0) AS points_gained_this_matchweek
  FROM lagged)"""


def _split(side: str, test: str) -> str:
    def total(condition: str, value: str) -> str:
        return f"CAST(sum(CASE WHEN {condition} THEN {value} ELSE 0 END) AS BIGINT)"

    return ",\n".join([
        f"{total(test, '1')} AS {side}_played",
        f"{total(test, 'points')} AS {side}_points",
        f"{total(test + ' AND goals_for > goals_against', '1')} AS {side}_wins",
        f"{total(test + ' AND goals_for = goals_against', '1')} AS {side}_draws",
        f"{total(test + ' AND goals_for < goals_against', '1')} AS {side}_losses",
        f"{total(test, 'goals_for')} AS {side}_goals_for",
        f"{total(test, 'goals_against')} AS {side}_goals_against",
    ])


def _split_shown(side: str) -> str:
    return f"""{side}_played, {side}_wins, {side}_draws, {side}_losses, {side}_points,
  {_half_up(side + '_points', side + '_played', 2)} AS {side}_ppg, {side}_goals_for, {side}_goals_against,
  {side}_goals_for - {side}_goals_against AS {side}_goal_difference,
  {_pct(side + '_wins', side + '_played')} AS {side}_win_pct"""


HOME_AWAY = PERFORMANCE + f""",
by_side AS (
  SELECT competition_code, team_id, season, {_split('home', 'is_home')}, {_split('away', 'NOT is_home')}
  FROM performance GROUP BY competition_code, team_id, season),
home_away AS (
  SELECT competition_code, team_id, season, {_split_shown('home')}, {_split_shown('away')} FROM by_side)"""

GOALS = PERFORMANCE + f""",
goal_totals AS (
  SELECT competition_code, team_id, season, count(*) AS played,
         CAST(sum(goals_for) AS BIGINT) AS goals_for, CAST(sum(goals_against) AS BIGINT) AS goals_against,
         count(*) FILTER (WHERE goals_against = 0) AS clean_sheets,
         count(*) FILTER (WHERE goals_for = 0) AS matches_failed_to_score
  FROM performance GROUP BY competition_code, team_id, season),
goal_analysis AS (
  SELECT competition_code, team_id, season, played, goals_for, goals_against,
         {_half_up('goals_for', 'played', 2)} AS goals_for_per_match,
         {_half_up('goals_against', 'played', 2)} AS goals_against_per_match,
         clean_sheets, {_pct('clean_sheets', 'played')} AS clean_sheet_pct,
         matches_failed_to_score, {_pct('matches_failed_to_score', 'played')} AS failed_to_score_pct
  FROM goal_totals)"""

# The provider's own table with its two planted errors.
PROVIDER = """provider_totals AS (
  SELECT competition_code, season, match_stage AS stage, team_id, count(*) AS played_games,
         count(*) FILTER (WHERE result = 'WIN') AS won, count(*) FILTER (WHERE result = 'DRAW') AS draw,
         count(*) FILTER (WHERE result = 'LOSS') AS lost, CAST(sum(points) AS BIGINT) AS true_points,
         CAST(sum(goals_for) AS BIGINT) AS goals_for, CAST(sum(goals_against) AS BIGINT) AS goals_against,
         CAST(sum(goal_difference) AS BIGINT) AS true_difference
  FROM performance WHERE match_stage IN ('REGULAR_SEASON', 'LEAGUE_STAGE', 'GROUP_STAGE')
  GROUP BY competition_code, season, match_stage, team_id),
provider AS (
  SELECT competition_code, season, DATE '2001-08-02' AS snapshot_date,
         TIMESTAMP '2001-08-02 18:00:00' AS loaded_at, stage, 'TOTAL' AS standing_type,
         CAST(row_number() OVER (PARTITION BY competition_code, season, stage
              ORDER BY true_points DESC, true_difference DESC, goals_for DESC, team_id) AS BIGINT) AS api_position,
         team_id, 'Team ' || lpad(CAST(team_id AS VARCHAR), 2, '0') AS team_name,
         played_games, won, draw, lost,
         true_points + CASE WHEN team_id % 7 = 0 THEN 1 ELSE 0 END AS points, goals_for, goals_against,
         true_difference - CASE WHEN team_id = 13 THEN 2 ELSE 0 END AS goal_difference
  FROM provider_totals)"""

RECONCILED = SNAPSHOTS + ",\n" + PROVIDER + """,
detail AS (
  SELECT p.competition_code, p.season, p.snapshot_date, p.played_games AS matchweek, p.team_id, p.team_name,
         p.api_position, s.league_position AS derived_position, p.points AS api_points, s.points AS derived_points,
         p.goal_difference AS api_goal_difference, s.goal_difference AS derived_goal_difference
  FROM provider p JOIN snapshots s ON s.competition_code = p.competition_code AND s.team_id = p.team_id
       AND s.season = p.season AND s.matchweek = p.played_games),
checks AS (
  SELECT competition_code, season, snapshot_date, CAST(team_id AS VARCHAR) AS entity_key,
         'standings_position' AS check_name, api_position AS source_value, derived_position AS derived_value
  FROM detail UNION ALL
  SELECT competition_code, season, snapshot_date, CAST(team_id AS VARCHAR), 'standings_points', api_points,
         derived_points FROM detail UNION ALL
  SELECT competition_code, season, snapshot_date, CAST(team_id AS VARCHAR), 'standings_goal_difference',
         api_goal_difference, derived_goal_difference FROM detail)"""

# ---- the run log, straight from events ----------------------------------------------------------

RUNS = """
told AS (
  SELECT *, 1994 + (event_id + user_id) % 9 AS season_year,
         CASE event_id % 4 WHEN 0 THEN 'competitions' WHEN 1 THEN 'teams' WHEN 2 THEN 'matches'
              ELSE 'standings' END AS dataset
  FROM events),
judged AS (
  SELECT *, CASE WHEN event_id % 50 = 0 THEN 'RUNNING'
                 WHEN event_type = 'error' OR (dataset = 'standings' AND season_year % 2 = 1) THEN 'FAILED'
                 ELSE 'SUCCESS' END AS status,
         CAST(floor(value * 10) AS BIGINT) AS received, CAST(floor(value) AS BIGINT) % 3 AS rejected
  FROM told),
runs AS (
  SELECT 'run-' || CAST(event_id AS VARCHAR) AS run_id,
         CASE WHEN event_type IN ('click', 'view') THEN 'leaguelake.daily' ELSE 'leaguelake.backfill' END AS pipeline_name,
         dataset, 'C' || CAST(user_id % 6 + 1 AS VARCHAR) AS competition_code,
         CAST(season_year AS VARCHAR) AS season, status, ts AS started_at,
         CASE WHEN status <> 'RUNNING' THEN ts + to_seconds(CAST(floor(value) AS BIGINT) + 1) END AS completed_at,
         CASE WHEN status = 'SUCCESS' THEN received END AS records_received,
         CASE WHEN status = 'SUCCESS' THEN greatest(received - rejected, 0) END AS records_inserted,
         CASE WHEN status = 'SUCCESS' THEN rejected END AS records_rejected,
         CASE WHEN status = 'FAILED' THEN 'failed: ' || props END AS error_message
  FROM judged)"""

# ---- the data tests over every model ------------------------------------------------------------

EVERY_MODEL = (
    TABLE
    + ",\n" + LEAGUE_PROGRESSION.split("FROM progression)", 1)[1].lstrip(",\n")
    + ",\n" + HOME_AWAY.split("FROM sides)", 1)[1].lstrip(",\n")
    + ",\n" + GOALS.split("FROM sides)", 1)[1].lstrip(",\n")
    + ",\n" + PROVIDER
    + """,
stg_matches AS (SELECT *, hg AS full_time_home_goals, ag AS full_time_away_goals FROM matches),
raw_matches AS (SELECT m.*, r.run_id FROM matches m, (VALUES ('load-1'), ('load-2')) AS r(run_id)),
raw_teams AS (SELECT s.*, r.run_id FROM stg_teams s, (VALUES ('load-1'), ('load-2')) AS r(run_id)),
stg_competitions AS (SELECT DISTINCT competition_code,
  2000 + CAST(substr(competition_code, 2, 1) AS BIGINT) AS competition_id FROM matches),
raw_competitions AS (SELECT c.*, r.run_id FROM stg_competitions c, (VALUES ('load-1'), ('load-2')) AS r(run_id)),
raw_standings AS (SELECT DISTINCT competition_code, season FROM provider),
dim_season AS (SELECT competition_code, season FROM matches GROUP BY competition_code, season),
dim_matchweek AS (SELECT competition_code, season, matchweek FROM matches WHERE matchweek IS NOT NULL
  GROUP BY competition_code, season, matchweek),
dim_date AS (SELECT CAST(unnest(generate_series(min(kickoff_utc), max(kickoff_utc), INTERVAL 1 DAY)) AS DATE)
  AS date_key FROM matches)"""
)

_MODEL_SOURCES = {
    "int_match_team_performance": "performance", "int_table_progression": "progression", "stg_standings": "provider",
    "fact_match": "stg_matches", "fact_team_match": "performance", "fact_standing_snapshot": "snapshots",
    "mart_league_table": "league_table", "mart_league_progression": "league_progression", "mart_team_form": "form",
    "mart_home_away_performance": "home_away", "mart_goal_analysis": "goal_analysis",
}
_STATUSES = "'SCHEDULED','TIMED','IN_PLAY','PAUSED','FINISHED','SUSPENDED','POSTPONED','CANCELLED','AWARDED'"
_NOT_NULL = {
    "raw_competitions": "competition_code run_id", "raw_teams": "competition_code run_id",
    "raw_matches": "match_id competition_code season", "raw_standings": "competition_code season",
    "stg_competitions": "competition_code competition_id", "stg_teams": "team_id competition_code season",
    "stg_matches": "match_id home_team_id away_team_id", "stg_standings": "team_id api_position points",
    "int_match_team_performance": "match_id team_id",
    "int_table_progression": "team_id competition_code league_position points",
    "dim_team": "team_id team_name", "dim_season": "season", "dim_date": "date_key",
    "fact_match": "match_id home_team_id away_team_id", "fact_team_match": "team_id",
    "fact_standing_snapshot": "team_id league_position", "mart_league_table": "team_id league_position",
}
_UNIQUE = {"stg_competitions": "competition_code", "stg_matches": "match_id", "dim_team": "team_id",
           "dim_date": "date_key", "fact_match": "match_id"}
_UNIQUE_TOGETHER = {
    "int_match_team_performance": "match_id team_id",
    "int_table_progression": "competition_code team_id as_of_match_id",
    "dim_season": "competition_code season", "dim_matchweek": "competition_code season matchweek",
    "fact_team_match": "match_id team_id", "fact_standing_snapshot": "competition_code season matchweek team_id",
    "mart_league_table": "competition_code team_id season",
    "mart_league_progression": "competition_code team_id season matchweek", "mart_team_form": "match_id team_id",
    "mart_home_away_performance": "competition_code team_id season",
    "mart_goal_analysis": "competition_code team_id season",
}
_FOREIGN = [("fact_match", "home_team_id"), ("fact_match", "away_team_id"), ("fact_team_match", "team_id"),
            ("fact_standing_snapshot", "team_id")]
_PREDICATES = [
    ("stg_matches", "accepted_values_match_status", f"match_status NOT IN ({_STATUSES})", "FAIL"),
    ("stg_matches", "accepted_range_full_time_home_goals", "full_time_home_goals < 0", "WARN"),
    ("stg_matches", "accepted_range_full_time_away_goals", "full_time_away_goals < 0", "WARN"),
    ("int_match_team_performance", "accepted_values_result", "result NOT IN ('WIN','DRAW','LOSS')", "FAIL"),
    ("int_match_team_performance", "accepted_values_points", "points NOT IN (0, 1, 3)", "FAIL"),
    ("fact_team_match", "accepted_values_points", "points NOT IN (0, 1, 3)", "FAIL"),
    ("stg_matches", "home_team_not_away_team", "home_team_id = away_team_id", "FAIL"),
    ("fact_match", "winner_matches_score", """match_status IN ('FINISHED', 'AWARDED') AND winner <> CASE sign(full_time_home_goals - full_time_away_goals)
        WHEN 1 THEN 'HOME_TEAM' WHEN -1 THEN 'AWAY_TEAM' WHEN 0 THEN 'DRAW' END""", "FAIL"),
]


def _every_check(spoilt: dict[str, str] | None = None) -> str:
    """All checks; spoilt says which tables stand for some of the models."""
    sources = _MODEL_SOURCES | (spoilt or {})

    def line(model: str, test: str, severity: str, failing: str) -> str:
        return (f"SELECT '{model}' AS model_name, '{test}' AS test_name, '{severity}' AS severity, "
                f"({failing}) AS failing")

    def source(model: str) -> str:
        return sources.get(model, model)

    def where(model: str, condition: str) -> str:
        return f"SELECT count(*) FILTER (WHERE {condition}) FROM {source(model)}"

    def repeated(model: str, columns: str, wrong: str = "> 1") -> str:
        return f"SELECT count(*) FROM (SELECT 1 FROM {source(model)} GROUP BY {columns} HAVING count(*) {wrong})"

    lines = [line(m, f"not_null_{c}", "FAIL", where(m, f"{c} IS NULL")) for m, cs in _NOT_NULL.items() for c in cs.split()]
    lines += [line(m, f"unique_{c}", "FAIL", repeated(m, c)) for m, c in _UNIQUE.items()]
    lines += [
        line(m, f"unique_combination_{cs.replace(' ', '_')}", "FAIL", repeated(m, cs.replace(" ", ", ")))
        for m, cs in _UNIQUE_TOGETHER.items()
    ]
    lines += [
        line(m, f"relationships_{c}_dim_team", "FAIL",
             f"SELECT count(*) FROM {source(m)} WHERE {c} NOT IN (SELECT team_id FROM dim_team)")
        for m, c in _FOREIGN
    ]
    lines += [line(m, test, severity, where(m, condition)) for m, test, condition, severity in _PREDICATES]
    lines.append(line("fact_team_match", "two_team_rows_per_match", "FAIL", repeated("fact_team_match", "match_id", "<> 2")))
    return (
        "SELECT model_name, test_name, CASE WHEN failing = 0 THEN 'PASS' ELSE severity END AS status, "
        "failing AS failing_row_count FROM (" + "\nUNION ALL\n".join(lines) + ")"
    )


LOADS = """loads AS (
  SELECT * FROM (VALUES ('load-1', TIMESTAMP '2001-08-02 06:00:00'), ('load-2', TIMESTAMP '2001-08-02 18:00:00'))
    AS v(run_id, loaded_at))"""

# What the provider's fields are read as.
_FIELDS = {
    "competitions": """id bigint, name string, code string, type string, area.name string, area.code string,
        currentSeason.id bigint, currentSeason.startDate date, currentSeason.endDate date, currentSeason.currentMatchday bigint""",
    "teams": """id bigint, name string, shortName string, tla string, crest string, founded bigint, clubColors string, venue string""",
    "matches": """id string, matchday bigint, utcDate timestamp_ntz, status string, stage string, homeTeam.id bigint,
        homeTeam.name string, awayTeam.id bigint, awayTeam.name string, score.winner string, score.fullTime.home bigint,
        score.fullTime.away bigint, score.halfTime.home bigint, score.halfTime.away bigint""",
    "standings": """position bigint, team.id bigint, team.name string, playedGames bigint, won bigint, draw bigint, lost bigint,
        points bigint, goalsFor bigint, goalsAgainst bigint, goalDifference bigint""",
}


def _fields(dataset: str) -> str:
    pairs = [f.split() for f in _FIELDS[dataset].split(",")]
    return "(VALUES " + ", ".join(f"('{path}', '{kind}')" for path, kind in pairs) + ") AS f(field, wanted)"


#: In a load of results these are there for counted matches only; in one of fixtures never.
_SCORED = "field LIKE 'score.%'"

UNIT = "competition_code = '{competition}' AND season = '{season}'"


def _with(ctes: str, query: str) -> str:
    return f"WITH {ctes.strip()}\n{query}"


def statements(competition: str, season: str, team_a: int, team_b: int, team_ids: list[int]) -> dict[str, str]:
    unit = UNIT.format(competition=competition, season=season)
    ids = ", ".join(str(i) for i in team_ids)
    perf_columns = (
        "match_id, competition_code, season, matchweek, match_stage, kickoff_utc, team_id, opponent_team_id, is_home, "
        "goals_for, goals_against, goal_difference, result, points"
    )
    name = TEAM_NAME.format
    staged = f"""SELECT match_id, competition_code, season, matchweek, kickoff_utc, match_status, match_stage,
  home_team_id, {name(id='home_team_id')} AS home_team_name, away_team_id, {name(id='away_team_id')} AS away_team_name,
  winner, hg AS full_time_home_goals, ag AS full_time_away_goals, hg // 2 AS half_time_home_goals,
  ag // 2 AS half_time_away_goals, TIMESTAMP '2001-08-02 18:00:00' AS loaded_at FROM matches"""
    table_columns = (
        "team_id, team_name, team_crest_url, league_position, played_games, won, drawn, lost, goals_for, "
        "goals_against, goal_difference, points, points_per_game, form_last_5"
    )
    named_team = "team_id, " + name(id="team_id") + " AS team_name"
    initials = "replace(replace(replace(replace(form_last_5, 'WIN', 'W'), 'DRAW', 'D'), 'LOSS', 'L'), ',', '')"
    signed = ("CASE WHEN goal_difference > 0 THEN '+' || CAST(goal_difference AS VARCHAR) "
              "ELSE CAST(goal_difference AS VARCHAR) END")
    pivoted = ", ".join(
        f"max(CASE WHEN team_id = {i} THEN league_position END) AS \"Team {i:02d}\"" for i in range(20)
    )
    broken_round = ("CASE WHEN matchweek % 11 = 0 THEN 'payload is not JSON' "
                    "WHEN matchweek % 13 = 0 OR matchweek % 17 = 0 THEN 'missing or malformed: matches' END")
    return {
        "stg_matches": _with(MATCHES, staged),
        "stg_teams": _with(MATCHES + ",\n" + TEAMS, "SELECT * FROM stg_teams"),
        "stg_competitions": _with(
            MATCHES + """,
newest AS (SELECT competition_code, season, min(kickoff_utc) AS first_kickoff, max(kickoff_utc) AS last_kickoff,
                  max(matchweek) AS last_week,
                  row_number() OVER (PARTITION BY competition_code ORDER BY season DESC) AS rn
           FROM matches GROUP BY competition_code, season)""",
            """SELECT competition_code, 2000 + CAST(substr(competition_code, 2, 1) AS BIGINT) AS competition_id,
  'Competition ' || competition_code AS competition_name, competition_code AS competition_code_from_api,
  CASE WHEN competition_code = 'C2' THEN 'CUP' ELSE 'LEAGUE' END AS competition_type,
  'Area ' || CAST(6 - CAST(substr(competition_code, 2, 1) AS BIGINT) AS VARCHAR) AS area_name,
  'A' || CAST(6 - CAST(substr(competition_code, 2, 1) AS BIGINT) AS VARCHAR) AS area_code,
  CAST(season AS BIGINT) * 10 + CAST(substr(competition_code, 2, 1) AS BIGINT) AS current_season_id,
  CAST(first_kickoff AS DATE) AS current_season_start_date, CAST(last_kickoff AS DATE) AS current_season_end_date,
  last_week AS current_matchday, TIMESTAMP '2001-08-02 18:00:00' AS loaded_at FROM newest WHERE rn = 1""",
        ),
        "stg_standings": _with(
            PERFORMANCE + ",\n" + PROVIDER,
            """SELECT competition_code, season, snapshot_date, loaded_at, stage, standing_type, api_position, team_id,
  team_name, played_games, won, draw, lost, points, goals_for, goals_against, goal_difference FROM provider""",
        ),
        "match_team_performance": _with(PERFORMANCE, f"SELECT {perf_columns} FROM performance"),
        "table_progression": _with(SNAPSHOTS, "SELECT * FROM progression"),
        "dim_team": _with(MATCHES + ",\n" + TEAMS, "SELECT * FROM dim_team"),
        "dim_season": _with(
            MATCHES,
            """SELECT competition_code, season, CAST(min(kickoff_utc) AS DATE) AS season_start_date,
  CAST(max(kickoff_utc) AS DATE) AS season_end_date, max(matchweek) AS total_matchweeks,
  count(DISTINCT match_id) AS total_matches FROM matches GROUP BY competition_code, season""",
        ),
        "dim_matchweek": _with(
            MATCHES,
            """SELECT competition_code, season, matchweek, min(kickoff_utc) AS matchweek_start_utc,
  max(kickoff_utc) AS matchweek_end_utc, count(DISTINCT match_id) AS matches_in_week
  FROM matches WHERE matchweek IS NOT NULL GROUP BY competition_code, season, matchweek""",
        ),
        "dim_date": _with(
            MATCHES + """,
bounds AS (SELECT min(kickoff_utc) AS first_day, max(kickoff_utc) AS last_day FROM matches),
days AS (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)""",
            """SELECT d AS date_key, d AS date_day, year(d) AS year, month(d) AS month, day(d) AS day_of_month,
  left(dayname(d), 3) AS day_name, quarter(d) AS quarter, weekofyear(d) AS week_of_year,
  isodow(d) IN (6, 7) AS is_weekend FROM days""",
        ),
        "fact_match": _with(
            MATCHES,
            f"""SELECT match_id, competition_code, season, matchweek, kickoff_utc, CAST(kickoff_utc AS DATE) AS match_date,
  match_status, match_stage, home_team_id, {name(id='home_team_id')} AS home_team_name, away_team_id,
  {name(id='away_team_id')} AS away_team_name, hg AS full_time_home_goals, ag AS full_time_away_goals,
  hg + ag AS total_goals, hg - ag AS goal_difference_home_minus_away, hg // 2 AS half_time_home_goals,
  ag // 2 AS half_time_away_goals, winner FROM matches""",
        ),
        "fact_team_match": _with(
            PERFORMANCE, f"SELECT {perf_columns}, CAST(kickoff_utc AS DATE) AS match_date FROM performance"
        ),
        "fact_standing_snapshot": _with(SNAPSHOTS, "SELECT * FROM snapshots"),
        "league_table": _with(TABLE, "SELECT * FROM league_table"),
        "league_progression": _with(LEAGUE_PROGRESSION, "SELECT * FROM league_progression"),
        "team_form": _with(FORM, "SELECT * FROM form"),
        "home_away": _with(HOME_AWAY, "SELECT * FROM home_away"),
        "goal_analysis": _with(GOALS, "SELECT * FROM goal_analysis"),
        "reconciliation_detail": _with(RECONCILED, "SELECT * FROM detail"),
        "reconciliation_checks": _with(
            RECONCILED, "SELECT *, source_value IS NOT DISTINCT FROM derived_value AS is_match FROM checks"
        ),
        "reconciliation_summary": _with(
            RECONCILED,
            """, compared AS (SELECT competition_code, count(*) AS checks_run,
    count(*) FILTER (WHERE source_value IS DISTINCT FROM derived_value) AS mismatches FROM checks GROUP BY 1),
  dropped AS (SELECT p.competition_code, count(*) AS unmatched_rows FROM provider p
    LEFT JOIN snapshots s ON s.competition_code = p.competition_code AND s.team_id = p.team_id
      AND s.season = p.season AND s.matchweek = p.played_games
    WHERE s.competition_code IS NULL GROUP BY 1)
  SELECT coalesce(c.competition_code, d.competition_code) AS competition_code,
    coalesce(checks_run, 0) // 3 AS rows_compared, coalesce(checks_run, 0) AS checks_run,
    coalesce(mismatches, 0) AS mismatches, coalesce(unmatched_rows, 0) AS unmatched_rows,
    CASE WHEN coalesce(checks_run, 0) = 0 THEN 'PASS (nothing compared)' WHEN mismatches = 0 THEN 'PASS'
         ELSE 'FAIL' END AS outcome
  FROM compared c FULL JOIN dropped d ON d.competition_code = c.competition_code""",
        ),
        "run_state": _with(
            RUNS,
            """SELECT run_id, pipeline_name, dataset, competition_code, season, status, started_at, completed_at,
  records_received, records_inserted, records_rejected, error_message FROM runs""",
        ),
        "recent_runs": _with(
            RUNS,
            """SELECT run_id, pipeline_name, dataset, competition_code, season, status, started_at, completed_at,
  records_received, records_inserted, records_rejected, error_message FROM runs
  ORDER BY started_at DESC NULLS FIRST, run_id DESC LIMIT 20""",
        ),
        "pipeline_summary": _with(
            RUNS,
            f"""SELECT count(*) AS total_runs, count(*) FILTER (WHERE status = 'SUCCESS') AS successful_runs,
  count(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
  CAST(sum(records_inserted) AS BIGINT) AS total_records_inserted,
  max(CASE WHEN status = 'SUCCESS' THEN completed_at END) AS last_success_at,
  {_pct("count(*) FILTER (WHERE status = 'SUCCESS')", 'count(*)')} AS success_rate_pct FROM runs""",
        ),
        "season_work_list": _with(
            MATCHES + "," + RUNS + """,
span AS (SELECT competition_code, min(CAST(season AS BIGINT)) AS first_season,
                max(max(CAST(season AS BIGINT))) OVER () AS last_season FROM matches GROUP BY competition_code),
wanted AS (SELECT competition_code, CAST(y.s AS VARCHAR) AS season, d.dataset, y.s = last_season AS is_current
           FROM span, unnest(generate_series(first_season, last_season)) AS y(s),
                (VALUES ('teams'), ('matches'), ('standings')) AS d(dataset)),
done AS (SELECT DISTINCT dataset, competition_code, season FROM runs WHERE status = 'SUCCESS')""",
            """SELECT w.dataset, w.competition_code, w.season, w.is_current FROM wanted w
  WHERE w.is_current OR NOT EXISTS (SELECT 1 FROM done d WHERE d.dataset = w.dataset
    AND d.competition_code = w.competition_code AND d.season = w.season)""",
        ),
        "envelope_quarantine": _with(
            MATCHES + f""",
{LOADS},
spoiled AS (SELECT competition_code, season, matchweek, {broken_round} AS reason FROM matches),
rejected AS (SELECT DISTINCT competition_code, season, matchweek, reason FROM spoiled WHERE reason IS NOT NULL)""",
            """SELECT 'matches' AS dataset, competition_code, season, reason, count(*) AS rejected_responses
  FROM rejected, loads GROUP BY competition_code, season, reason""",
        ),
        "land_matches": _with(
            MATCHES + f""",
{LOADS},
spoiled AS (SELECT *, {broken_round} AS reason FROM matches)""",
            """SELECT competition_code, season, CAST(matchweek AS VARCHAR) AS matchweek, match_id, run_id,
  'orders-feed' AS source, loaded_at, CASE WHEN run_id = 'load-2' THEN match_status ELSE 'TIMED' END AS status,
  CASE WHEN run_id = 'load-2' THEN hg END AS home_goals FROM spoiled, loads WHERE reason IS NULL""",
        ),
        "land_competitions": _with(
            MATCHES + f""",
{LOADS}""",
            """SELECT DISTINCT competition_code, run_id, 'orders-feed' AS source, loaded_at,
  'Competition ' || competition_code AS name FROM matches, loads""",
        ),
        "land_teams": _with(
            MATCHES + ",\n" + TEAMS + f""",
{LOADS}""",
            """SELECT competition_code, season, run_id, 'orders-feed' AS source, l.loaded_at, team_id,
  team_name || CASE WHEN run_id = 'load-1' THEN ' (provisional)' ELSE '' END AS name FROM stg_teams s, loads l""",
        ),
        "land_standings": _with(
            PERFORMANCE + f""",
{LOADS},
sided AS (SELECT competition_code, season, match_stage, unnest(['TOTAL', CASE WHEN is_home THEN 'HOME' ELSE 'AWAY' END])
            AS kind FROM performance WHERE match_stage IN ('REGULAR_SEASON', 'LEAGUE_STAGE', 'GROUP_STAGE'))""",
            """SELECT competition_code, season, DATE '2001-08-02' AS snapshot_date, run_id, 'orders-feed' AS source,
  loaded_at, count(DISTINCT match_stage || kind) AS tables
  FROM sided, loads GROUP BY competition_code, season, run_id, loaded_at""",
        ),
        "team_filter": _with(
            MATCHES + ",\n" + TEAMS + f""",
{LOADS}""",
            f"SELECT competition_code, season, run_id, team_id FROM stg_teams, loads WHERE season = '{season}'",
        ),
        "streamed_league_table": _with(TABLE, "SELECT * FROM league_table"),
        "one_run_league_table": _with(TABLE, "SELECT * FROM league_table"),
        "stream_quarantine": _with(
            MATCHES + """,
units AS (SELECT DISTINCT competition_code, season FROM matches),
kinds(dataset, reason) AS (VALUES ('unknown', 'line is not JSON'), ('referees', 'unknown dataset'),
                                  ('matches', 'missing competition'), ('standings', 'missing season'))""",
            "SELECT dataset, reason, count(*) AS lines FROM kinds, units GROUP BY dataset, reason",
        ),
        "stream_runs": _with(
            PERFORMANCE + """,
units AS (SELECT DISTINCT competition_code, season FROM matches),
tables AS (SELECT DISTINCT competition_code, season FROM performance
           WHERE match_stage IN ('REGULAR_SEASON', 'LEAGUE_STAGE', 'GROUP_STAGE'))""",
            """SELECT 'teams' AS dataset, 'SUCCESS' AS status, count(*) AS runs FROM units
  UNION ALL SELECT 'matches', 'SUCCESS', count(*) FROM units
  UNION ALL SELECT 'standings', 'SUCCESS', count(*) FROM tables
  UNION ALL SELECT 'competitions', 'SUCCESS', count(DISTINCT competition_code) FROM units""",
        ),
        "match_filter": _with(
            MATCHES,
            f"""SELECT match_id, competition_code, season, matchweek, kickoff_utc, match_status FROM matches
  WHERE season = '{season}' AND match_status = 'FINISHED'
    AND CAST(kickoff_utc AS DATE) >= DATE '{season}-09-01' AND CAST(kickoff_utc AS DATE) <= DATE '{season}-12-31'""",
        ),
        "season_labels": _with(
            MATCHES,
            """SELECT competition_code, max(season) AS season,
  max(season) || '/' || substr(CAST(CAST(max(season) AS BIGINT) + 1 AS VARCHAR), 3) AS season_label
  FROM matches GROUP BY competition_code""",
        ),
        "api_competitions": _with(
            MATCHES,
            """SELECT DISTINCT competition_code, 'Competition ' || competition_code AS competition_name,
  'Area ' || CAST(6 - CAST(substr(competition_code, 2, 1) AS BIGINT) AS VARCHAR) AS area_name FROM matches""",
        ),
        "api_seasons": _with(
            MATCHES,
            f"""SELECT season, CAST(min(kickoff_utc) AS DATE) AS season_start_date,
  CAST(max(kickoff_utc) AS DATE) AS season_end_date, max(matchweek) AS total_matchweeks
  FROM matches WHERE competition_code = '{competition}' GROUP BY season""",
        ),
        "api_teams": _with(
            MATCHES + ",\n" + TEAMS,
            f"""SELECT DISTINCT t.team_id, t.team_name, t.team_short_name, t.team_tla, t.team_crest_url
  FROM stg_teams s JOIN dim_team t ON t.team_id = s.team_id WHERE s.competition_code = '{competition}'""",
        ),
        "api_teams_season": _with(
            TABLE,
            f"""SELECT DISTINCT t.team_id, t.team_name, t.team_short_name, t.team_tla, t.team_crest_url
  FROM league_table l JOIN dim_team t ON t.team_id = l.team_id
  WHERE l.competition_code = '{competition}' AND l.season = '{season}'""",
        ),
        "api_league_table": _with(TABLE, f"SELECT {table_columns} FROM league_table WHERE {unit}"),
        "league_table_display": _with(
            TABLE,
            f"SELECT {table_columns}, {signed} AS goal_difference_shown, {initials} AS form_shown "
            f"FROM league_table WHERE {unit}",
        ),
        "api_progression": _with(
            LEAGUE_PROGRESSION,
            f"""SELECT {named_team}, matchweek, league_position, points, position_change
  FROM league_progression WHERE {unit}""",
        ),
        "api_progression_teams": _with(
            LEAGUE_PROGRESSION,
            f"""SELECT {named_team}, matchweek, league_position, points, position_change
  FROM league_progression WHERE {unit} AND team_id IN ({ids})""",
        ),
        "progression_matrix": _with(
            LEAGUE_PROGRESSION, f"SELECT matchweek, {pivoted} FROM league_progression WHERE {unit} GROUP BY matchweek"
        ),
        "api_team_form": _with(
            FORM,
            f"""SELECT match_id, matchweek, kickoff_utc, result, points, ppg_last_5, ppg_last_10, form_last_5
  FROM form WHERE {unit} AND team_id = {team_a}""",
        ),
        "api_home_away": _with(
            HOME_AWAY,
            f"""SELECT {named_team}, home_played, home_points, home_ppg, home_win_pct, home_goal_difference,
  away_played, away_points, away_ppg, away_win_pct, away_goal_difference FROM home_away WHERE {unit}""",
        ),
        "api_goal_analysis": _with(
            GOALS,
            f"""SELECT {named_team}, played, goals_for, goals_against, goals_for_per_match, goals_against_per_match,
  clean_sheets, clean_sheet_pct, matches_failed_to_score, failed_to_score_pct FROM goal_analysis WHERE {unit}""",
        ),
        "overview_kpis": _with(
            TABLE,
            f""", totals AS (SELECT competition_code, season, CAST(sum(played_games) AS BIGINT) AS team_games,
    CAST(sum(goals_for) AS BIGINT) AS total_goals, max(goals_for) AS top_scorer_goals
    FROM league_table GROUP BY competition_code, season),
  ordered AS (SELECT competition_code, season, team_name,
    row_number() OVER (PARTITION BY competition_code, season ORDER BY league_position, team_id) AS by_table,
    row_number() OVER (PARTITION BY competition_code, season
                       ORDER BY goals_for DESC, league_position, team_id) AS by_goals FROM league_table)
  SELECT t.competition_code, t.season, t.team_games / 2.0 AS matches_played, t.total_goals,
    {_half_up('2 * t.total_goals', 't.team_games', 2)} AS goals_per_match,
    a.team_name AS leader, b.team_name AS top_scorer, t.top_scorer_goals
  FROM totals t
  JOIN ordered a ON a.competition_code = t.competition_code AND a.season = t.season AND a.by_table = 1
  JOIN ordered b ON b.competition_code = t.competition_code AND b.season = t.season AND b.by_goals = 1""",
        ),
        "team_compare": _with(
            TABLE + ",\n" + HOME_AWAY.split("FROM sides)", 1)[1].lstrip(",\n") + ",\n"
            + GOALS.split("FROM sides)", 1)[1].lstrip(",\n"),
            f"""SELECT l.team_id, l.team_name, l.league_position, l.points, l.points_per_game, l.goal_difference,
  h.home_ppg, h.away_ppg, h.home_win_pct, h.away_win_pct, g.goals_for, g.goals_against, g.clean_sheet_pct,
  g.failed_to_score_pct
  FROM league_table l
  JOIN home_away h ON h.competition_code = l.competition_code AND h.season = l.season AND h.team_id = l.team_id
  JOIN goal_analysis g ON g.competition_code = l.competition_code AND g.season = l.season AND g.team_id = l.team_id
  WHERE l.competition_code = '{competition}' AND l.season = '{season}' AND l.team_id IN ({team_a}, {team_b})""",
        ),
        "dq_results": _with(EVERY_MODEL, _every_check()),
        "dq_summary": _with(
            EVERY_MODEL,
            "SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'FAIL') AS failed_checks "
            f"FROM ({_every_check()})",
        ),
        "dq_violations_seeded": _with(
            EVERY_MODEL + """,
spoilt AS (
  SELECT match_id, matchweek, CASE WHEN matchweek % 5 = 1 THEN NULL ELSE home_team_id END AS home_team_id,
         CASE WHEN matchweek % 5 = 2 THEN home_team_id WHEN matchweek % 5 = 0 THEN away_team_id + 1000
              ELSE away_team_id END AS away_team_id,
         CASE WHEN matchweek % 5 = 3 THEN 'UNKNOWN' ELSE match_status END AS match_status,
         CASE WHEN matchweek % 5 = 4 THEN -1 - hg ELSE hg END AS full_time_home_goals, ag AS full_time_away_goals, winner
  FROM matches),
doubled AS (SELECT * FROM spoilt UNION ALL SELECT * FROM spoilt WHERE matchweek % 5 = 3),
one_sided AS (SELECT * FROM performance WHERE is_home OR matchweek % 5 <> 1)""",
            _every_check({"stg_matches": "doubled", "fact_match": "doubled", "fact_team_match": "one_sided"}),
        ),
        "field_types": _with(
            PERFORMANCE + ",\n" + PROVIDER + f""",
{LOADS},
units AS (SELECT DISTINCT competition_code, season FROM matches)""",
            f"""SELECT 'matches' AS dataset, run_id, field, wanted, CASE WHEN NOT {_SCORED} THEN count(*)
    WHEN run_id = 'load-2' THEN count(hg) ELSE 0 END AS present, 0 AS mistyped
  FROM matches, loads, {_fields('matches')} GROUP BY run_id, field, wanted
  UNION ALL SELECT 'teams', run_id, field, wanted, 20 * count(*), 0
  FROM units, loads, {_fields('teams')} GROUP BY run_id, field, wanted
  UNION ALL SELECT 'competitions', run_id, field, wanted, count(DISTINCT competition_code), 0
  FROM units, loads, {_fields('competitions')} GROUP BY run_id, field, wanted
  UNION ALL SELECT 'standings', run_id, field, wanted, CASE WHEN run_id = 'load-2' THEN count(*) ELSE 0 END, 0
  FROM provider, loads, {_fields('standings')} GROUP BY run_id, field, wanted""",
        ),
        "field_types_spoilt": _with(
            MATCHES + f""",
{LOADS},
judged AS (SELECT run_id, field, wanted,
    CASE WHEN field LIKE 'homeTeam.%' THEN matchweek % 7 <> 6
         WHEN {_SCORED} THEN run_id = 'load-2' AND scored ELSE TRUE END AS there,
    CASE field WHEN 'matchday' THEN matchweek % 7 = 3 WHEN 'utcDate' THEN matchweek % 7 = 4
         WHEN 'score.fullTime.home' THEN matchweek % 7 = 5 ELSE FALSE END AS wrong
  FROM (SELECT matchweek, hg IS NOT NULL AS scored FROM matches) m, loads, {_fields('matches')})""",
            """SELECT 'matches' AS dataset, run_id, field, wanted, count(*) FILTER (WHERE there) AS present,
  count(*) FILTER (WHERE there AND wrong) AS mistyped FROM judged GROUP BY run_id, field, wanted""",
        ),
        "audit_trail": _with(
            EVERY_MODEL + ",\n" + RECONCILED.split(PROVIDER, 1)[1].lstrip(",\n"),
            f"""SELECT 'data tests' AS audit, run_id, status AS outcome, count(*) AS checks,
    CAST(sum(failing_row_count) AS BIGINT) AS failing_rows
  FROM ({_every_check()}), (VALUES ('audit-1'), ('audit-2')) AS r(run_id) GROUP BY run_id, status
  UNION ALL SELECT 'reconciliation', run_id, outcome, count(*), NULL FROM (
    SELECT CASE WHEN source_value IS NOT DISTINCT FROM derived_value THEN 'MATCH' ELSE 'MISMATCH' END AS outcome FROM checks),
    (VALUES ('audit-1'), ('audit-2')) AS r(run_id) GROUP BY run_id, outcome""",
        ),
        "run_state_folded": _with(
            RUNS,
            """SELECT run_id, pipeline_name, dataset, competition_code, season, status, started_at, completed_at,
  records_received, records_inserted, records_rejected, error_message FROM runs""",
        ),
        "pipeline_health": _with(
            EVERY_MODEL + "," + RUNS,
            f"""SELECT count(*) AS total_runs, count(*) FILTER (WHERE status = 'SUCCESS') AS successful_runs,
  count(*) FILTER (WHERE status = 'FAILED') AS failed_runs, CAST(sum(records_inserted) AS BIGINT) AS total_records_inserted,
  max(CASE WHEN status = 'SUCCESS' THEN completed_at END) AS last_success_at,
  {_pct("count(*) FILTER (WHERE status = 'SUCCESS')", 'count(*)')} AS success_rate_pct,
  (SELECT 2 * count(*) FROM ({_every_check()})) AS total_checks,
  (SELECT 2 * count(*) FILTER (WHERE status = 'FAIL') FROM ({_every_check()})) AS failed_checks,
  (SELECT string_agg(run_id, ' ' ORDER BY started_at DESC, run_id DESC) FROM (
    SELECT run_id, started_at FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 20)) AS recent_run_ids
  FROM runs""",
        ),
        "api_progression_listed": _with(
            LEAGUE_PROGRESSION,
            f"""SELECT {named_team}, matchweek, league_position, points, position_change
  FROM league_progression WHERE {unit} AND team_id IN (SELECT c_custkey FROM customer)""",
        ),
        "served_order": _with(
            LEAGUE_PROGRESSION + ",\n" + TEAMS,
            f"""SELECT 'competitions' AS question, competition_code AS shown,
    row_number() OVER (ORDER BY 'Competition ' || competition_code) AS place
  FROM (SELECT DISTINCT competition_code FROM matches)
  UNION ALL SELECT 'seasons', season, row_number() OVER (ORDER BY season DESC)
  FROM (SELECT DISTINCT season FROM matches WHERE competition_code = '{competition}')
  UNION ALL SELECT 'teams', CAST(team_id AS VARCHAR), row_number() OVER (ORDER BY {name(id='team_id')})
  FROM (SELECT DISTINCT team_id FROM stg_teams WHERE competition_code = '{competition}')
  UNION ALL SELECT 'progression', team_id || ' ' || matchweek, row_number() OVER (ORDER BY team_id, matchweek)
  FROM league_progression WHERE {unit}
  UNION ALL SELECT 'team form', match_id, row_number() OVER (ORDER BY kickoff_utc, match_id)
  FROM performance WHERE {unit} AND team_id = {team_a}""",
        ),
    }
