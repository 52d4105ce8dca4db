"""Every query by name, each a function of the session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leaguelake.functions.expressions import field
from leaguelake.jobs import RAW_TABLES
from leaguelake.plans import audit, dimensions, facts, intermediate, marts, quality, reconcile, serving, staging
from leaguelake.plans.field_types import by_run as field_types_of
from leaguelake.sources import ingest, payloads
from leaguelake.sources.demo import Demo, demo

COMPETITION, SEASON = "C1", "1997"
TEAM_A, TEAM_B = 3, 11
TEAM_IDS = [1, 2, 13]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_COLUMNS = [
    "run_id", "pipeline_name", "dataset", "competition_code", "season", "status", "started_at", "completed_at",
    "records_received", "records_inserted", "records_rejected", "error_message",
]


def _query(make: Callable[[Demo], DataFrame]) -> Callable[[Demo], DataFrame]:
    QUERIES[make.__name__] = lambda spark, folder: make(demo(spark, folder))
    return make


def _joined_form(df: DataFrame) -> DataFrame:
    """Form as text, so that it compares across engines."""
    return df.withColumn("form_last_5", F.array_join("form_last_5", ","))


# ---- landing --------------------------------------------------------------------------------


@_query
def land_matches(d: Demo) -> DataFrame:
    rows = payloads.land_matches(d.damaged_match_envelopes()).rows
    return rows.select(
        *[c for c in rows.columns if c not in ("raw_json", "arrival")],
        field("raw_json", "status").alias("status"),
        field("raw_json", "score.fullTime.home", "bigint").alias("home_goals"),
    )


@_query
def land_competitions(d: Demo) -> DataFrame:
    rows = payloads.land_competitions(d.envelopes("competitions")).rows
    return rows.select("competition_code", "run_id", "source", "loaded_at", field("raw_json", "name").alias("name"))


@_query
def land_teams(d: Demo) -> DataFrame:
    rows = payloads.land_teams(d.envelopes("teams")).rows
    return rows.select(
        "competition_code", "season", "run_id", "source", "loaded_at",
        field("raw_json", "id", "bigint").alias("team_id"), field("raw_json", "name").alias("name"),
    )


@_query
def land_standings(d: Demo) -> DataFrame:
    rows = payloads.land_standings(d.envelopes("standings")).rows
    return rows.select(
        "competition_code", "season", "snapshot_date", "run_id", "source", "loaded_at",
        F.size(F.try_variant_get("raw_json", "$.standings", "array<variant>")).cast("long").alias("tables"),
    )


@_query
def team_filter(d: Demo) -> DataFrame:
    return payloads.filter_season(d.raw("raw_teams"), SEASON).select(
        "competition_code", "season", "run_id", field("raw_json", "id", "bigint").alias("team_id")
    )


@_query
def streamed_league_table(d: Demo) -> DataFrame:
    """The league table of the lake that the stream filled and refreshed."""
    return _joined_form(d.streamed.stored("marts", "mart_league_table"))


@_query
def one_run_league_table(d: Demo) -> DataFrame:
    """The league table after both loads came in one batch, the newer one in the older files."""
    return _joined_form(d.one_run.stored("marts", "mart_league_table"))


@_query
def stream_quarantine(d: Demo) -> DataFrame:
    """Lines of the stream that could not be used, by reason."""
    return d.one_run.raw("raw_rejects").groupBy("dataset", "reason").agg(F.count(F.lit(1)).alias("lines"))


@_query
def stream_runs(d: Demo) -> DataFrame:
    """The runs that the stream recorded."""
    state = audit.run_state(d.one_run.audit("pipeline_run_audit"))
    return state.groupBy("dataset", "status").agg(F.count(F.lit(1)).alias("runs"))


@_query
def envelope_quarantine(d: Demo) -> DataFrame:
    rejects = payloads.land_matches(d.damaged_match_envelopes()).rejects
    return rejects.groupBy("dataset", "competition_code", "season", "reason").agg(
        F.count(F.lit(1)).alias("rejected_responses")
    )


@_query
def match_filter(d: Demo) -> DataFrame:
    chosen = payloads.filter_matches(
        d.raw("raw_matches"), season=SEASON, status="FINISHED", date_from=f"{SEASON}-09-01", date_to=f"{SEASON}-12-31"
    )
    return chosen.select(
        "match_id", "competition_code", "season", F.col("matchweek").cast("long").alias("matchweek"),
        field("raw_json", "utcDate", "timestamp_ntz").alias("kickoff_utc"),
        field("raw_json", "status").alias("match_status"),
    )


# ---- staging and intermediate ---------------------------------------------------------------


@_query
def stg_competitions(d: Demo) -> DataFrame:
    return staging.stg_competitions(d.raw("raw_competitions"))


@_query
def stg_teams(d: Demo) -> DataFrame:
    return staging.stg_teams(d.raw("raw_teams"))


@_query
def stg_matches(d: Demo) -> DataFrame:
    return staging.stg_matches(d.raw("raw_matches"))


@_query
def stg_standings(d: Demo) -> DataFrame:
    return staging.stg_standings(d.raw("raw_standings"))


@_query
def match_team_performance(d: Demo) -> DataFrame:
    return intermediate.match_team_performance(d.models.stg_matches)


@_query
def table_progression(d: Demo) -> DataFrame:
    return intermediate.table_progression(d.models.int_match_team_performance)


# ---- dimensions, facts, marts ---------------------------------------------------------------


@_query
def dim_team(d: Demo) -> DataFrame:
    return dimensions.dim_team(d.models.stg_teams)


@_query
def dim_season(d: Demo) -> DataFrame:
    return dimensions.dim_season(d.models.stg_matches)


@_query
def dim_matchweek(d: Demo) -> DataFrame:
    return dimensions.dim_matchweek(d.models.stg_matches)


@_query
def dim_date(d: Demo) -> DataFrame:
    return d.models.dim_date


@_query
def fact_match(d: Demo) -> DataFrame:
    return facts.fact_match(d.models.stg_matches)


@_query
def fact_team_match(d: Demo) -> DataFrame:
    return facts.fact_team_match(d.models.int_match_team_performance)


@_query
def fact_standing_snapshot(d: Demo) -> DataFrame:
    return facts.fact_standing_snapshot(d.models.int_table_progression)


@_query
def league_table(d: Demo) -> DataFrame:
    m = d.models
    return _joined_form(marts.mart_league_table(m.fact_standing_snapshot, m.dim_team, m.mart_team_form))


@_query
def league_progression(d: Demo) -> DataFrame:
    return marts.mart_league_progression(d.models.fact_standing_snapshot)


@_query
def team_form(d: Demo) -> DataFrame:
    return _joined_form(marts.mart_team_form(d.models.int_match_team_performance))


@_query
def home_away(d: Demo) -> DataFrame:
    return marts.mart_home_away_performance(d.models.int_match_team_performance)


@_query
def goal_analysis(d: Demo) -> DataFrame:
    return marts.mart_goal_analysis(d.models.int_match_team_performance)


# ---- reconciliation and quality -------------------------------------------------------------


@_query
def reconciliation_detail(d: Demo) -> DataFrame:
    m = d.models
    return reconcile.reconciliation_detail(m.stg_standings, m.fact_standing_snapshot, m.dim_team)


@_query
def reconciliation_checks(d: Demo) -> DataFrame:
    return reconcile.reconciliation_checks(reconciliation_detail(d))


@_query
def reconciliation_summary(d: Demo) -> DataFrame:
    m = d.models
    unmatched = reconcile.unmatched_standings(m.stg_standings, m.fact_standing_snapshot)
    return reconcile.reconciliation_summary(reconciliation_checks(d), unmatched)


@_query
def dq_results(d: Demo) -> DataFrame:
    return quality.quality_outcomes({name: d.raw(name) for name in RAW_TABLES} | d.models.build())


@_query
def dq_summary(d: Demo) -> DataFrame:
    return audit.quality_summary(dq_results(d))


def seeded_tables(d: Demo) -> dict[str, DataFrame]:
    """Copies with planted faults, one kind per matchweek modulo five."""
    turn = F.col("matchweek") % 5
    spoilt = (
        d.models.stg_matches.withColumn("original_home", F.col("home_team_id"))
        .withColumn("home_team_id", F.when(turn != 1, F.col("home_team_id")))
        .withColumn(
            "away_team_id",
            F.when(turn == 2, F.col("original_home")).when(turn == 0, F.col("away_team_id") + 1000).otherwise(
                F.col("away_team_id")
            ),
        )
        .withColumn("match_status", F.when(turn == 3, "UNKNOWN").otherwise(F.col("match_status")))
        .withColumn(
            "full_time_home_goals",
            F.when(turn == 4, -1 - F.col("full_time_home_goals")).otherwise(F.col("full_time_home_goals")),
        )
    )
    doubled = spoilt.unionByName(spoilt.filter(turn == 3))
    sides = d.models.int_match_team_performance.filter(F.col("is_home") | (turn != 1))
    return {
        "stg_matches": doubled,
        "fact_match": facts.fact_match(doubled),
        "fact_team_match": facts.fact_team_match(sides),
        "dim_team": d.models.dim_team,
    }


@_query
def dq_violations_seeded(d: Demo) -> DataFrame:
    """All data tests over tables some of which are spoilt."""
    tables = {name: d.raw(name) for name in RAW_TABLES} | d.models.build() | seeded_tables(d)
    return quality.quality_outcomes(tables)


@_query
def field_types(d: Demo) -> DataFrame:
    """How many fields of every load are there, and how many of them not of their type."""
    return reduce(DataFrame.unionAll, [field_types_of(d.raw(f"raw_{name}"), name) for name in payloads.LANDERS])


@_query
def field_types_spoilt(d: Demo) -> DataFrame:
    return field_types_of(d.mistyped_matches(), "matches")


@_query
def audit_trail(d: Demo) -> DataFrame:
    """What both audits hold after two runs and a repeated one."""
    lake = d.audited
    tests = lake.audit("data_quality_audit").groupBy("run_id", F.col("status").alias("outcome")).agg(
        F.count(F.lit(1)).alias("checks"), F.sum("failing_row_count").alias("failing_rows")
    )
    compared = lake.audit("reconciliation_audit").groupBy(
        "run_id", F.when(F.col("is_match"), "MATCH").otherwise("MISMATCH").alias("outcome")
    ).agg(F.count(F.lit(1)).alias("checks"), F.lit(None).cast("long").alias("failing_rows"))
    return tests.select(F.lit("data tests").alias("audit"), "*").unionByName(
        compared.select(F.lit("reconciliation").alias("audit"), "*")
    )


@_query
def pipeline_health(d: Demo) -> DataFrame:
    """The health answer in one row: totals of runs and data tests, and the newest runs in order."""
    answer = audit.pipeline_health(d.folded_runs, d.audited.audit("data_quality_audit"))
    newest = F.array_join(F.transform("recent_runs", lambda r: r["run_id"]), " ")
    return answer.select("summary.*", "data_quality.*", newest.alias("recent_run_ids"))


# ---- runs and planning ----------------------------------------------------------------------


@_query
def run_state(d: Demo) -> DataFrame:
    return audit.run_state(d.run_events).select(*RUN_COLUMNS)


@_query
def run_state_folded(d: Demo) -> DataFrame:
    """The same state, folded load by load."""
    return d.folded_runs.select(*RUN_COLUMNS)


@_query
def recent_runs(d: Demo) -> DataFrame:
    return audit.recent_runs(audit.run_state(d.run_events))


@_query
def pipeline_summary(d: Demo) -> DataFrame:
    return audit.success_rate(audit.run_summary(audit.run_state(d.run_events)))


@_query
def season_work_list(d: Demo) -> DataFrame:
    """Everything from each competition's first season to the newest one, less what is loaded."""
    season = F.col("season").cast("long")
    spans = d.models.dim_season.groupBy("competition_code").agg(F.min(season).alias("first_season"))
    newest = d.models.dim_season.agg(F.max(season).alias("current_season")).first()["current_season"]
    wanted = ingest.requested_units(spans, F.col("first_season"), F.lit(newest).cast("long"))
    return ingest.work_list(wanted, audit.loaded_units(audit.run_state(d.run_events)))


# ---- serving --------------------------------------------------------------------------------


@_query
def season_labels(d: Demo) -> DataFrame:
    return serving.default_season(d.models.dim_season)


@_query
def api_competitions(d: Demo) -> DataFrame:
    return serving.competitions(d.models.stg_competitions)


@_query
def api_seasons(d: Demo) -> DataFrame:
    return serving.seasons(d.models.dim_season, COMPETITION)


@_query
def api_teams(d: Demo) -> DataFrame:
    m = d.models
    return serving.teams(m.dim_team, m.stg_teams, m.mart_league_table, COMPETITION)


@_query
def api_teams_season(d: Demo) -> DataFrame:
    m = d.models
    return serving.teams(m.dim_team, m.stg_teams, m.mart_league_table, COMPETITION, SEASON)


@_query
def api_league_table(d: Demo) -> DataFrame:
    return _joined_form(serving.league_table(d.models.mart_league_table, SEASON, COMPETITION))


@_query
def league_table_display(d: Demo) -> DataFrame:
    table = serving.league_table(d.models.mart_league_table, SEASON, COMPETITION)
    return _joined_form(serving.displayed_league_table(table))


@_query
def api_progression(d: Demo) -> DataFrame:
    return serving.progression(d.models.mart_league_progression, d.models.dim_team, SEASON, COMPETITION)


@_query
def api_progression_teams(d: Demo) -> DataFrame:
    asked = serving.parse_team_ids(",".join(str(i) for i in TEAM_IDS))
    return serving.progression(d.models.mart_league_progression, d.models.dim_team, SEASON, COMPETITION, asked)


@_query
def api_progression_listed(d: Demo) -> DataFrame:
    """The teams named by a table of ids as large as the customers."""
    asked = d.table("customer").select(F.col("c_custkey").alias("team_id"))
    return serving.progression(d.models.mart_league_progression, d.models.dim_team, SEASON, COMPETITION, asked)


@_query
def served_order(d: Demo) -> DataFrame:
    """The place in which each row of an ordered answer comes."""

    def placed(name: str, answer: DataFrame, *shown: str) -> DataFrame:
        listed = answer.select(
            F.lit(name).alias("question"), F.concat_ws(" ", *[F.col(c).cast("string") for c in shown]).alias("shown"),
            F.monotonically_increasing_id().alias("at"),  # grows with the rows as they are served
        )
        return listed.select("question", "shown", F.row_number().over(Window.orderBy("at")).alias("place"))

    answers = [
        placed("competitions", api_competitions(d), "competition_code"),
        placed("seasons", api_seasons(d), "season"),
        placed("teams", api_teams(d), "team_id"),
        placed("progression", api_progression(d), "team_id", "matchweek"),
        placed("team form", api_team_form(d), "match_id"),
    ]
    return reduce(DataFrame.unionAll, answers)


@_query
def progression_matrix(d: Demo) -> DataFrame:
    return serving.progression_matrix(api_progression(d))


@_query
def api_team_form(d: Demo) -> DataFrame:
    return _joined_form(serving.team_form(d.models.mart_team_form, TEAM_A, SEASON, COMPETITION))


@_query
def api_home_away(d: Demo) -> DataFrame:
    return serving.home_away(d.models.mart_home_away_performance, d.models.dim_team, SEASON, COMPETITION)


@_query
def api_goal_analysis(d: Demo) -> DataFrame:
    return serving.goal_analysis(d.models.mart_goal_analysis, d.models.dim_team, SEASON, COMPETITION)


@_query
def overview_kpis(d: Demo) -> DataFrame:
    return serving.overview_kpis(d.models.mart_league_table)


@_query
def team_compare(d: Demo) -> DataFrame:
    m = d.models
    asked = m.dim_team.select("team_id").filter(F.col("team_id").isin(TEAM_A, TEAM_B))
    return serving.team_compare(
        m.mart_league_table, m.mart_home_away_performance, m.mart_goal_analysis, asked, SEASON, COMPETITION
    )
