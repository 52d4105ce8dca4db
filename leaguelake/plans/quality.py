"""The data tests: 67 declared checks, each counting the rows (or keys) that break it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.functions.expressions import row_key
from leaguelake.sources.schemas import COUNTED_STATUSES, MATCH_STATUSES, RESULT_POINTS, RESULTS

PASS, FAIL, WARN = "PASS", "FAIL", "WARN"


@dataclass(frozen=True)
class RowCheck:
    """Counts rows for which the SQL condition `broken` holds."""

    model: str
    name: str
    broken: str
    severity: str = FAIL


@dataclass(frozen=True)
class KeyCheck:
    """Counts keys whose number of rows `n` is wrong (by default: more than one)."""

    model: str
    name: str
    columns: tuple[str, ...]
    wrong: str = "n > 1"
    skip_null_keys: bool = False
    severity: str = FAIL


@dataclass(frozen=True)
class ParentCheck:
    """Counts rows whose key has no parent row; a null key needs none."""

    model: str
    name: str
    column: str
    parent: str
    parent_column: str
    severity: str = FAIL


Check = RowCheck | KeyCheck | ParentCheck


def not_null(model: str, *columns: str) -> list[Check]:
    return [RowCheck(model, f"not_null_{c}", f"{c} IS NULL") for c in columns]


def unique(model: str, column: str) -> Check:
    return KeyCheck(model, f"unique_{column}", (column,), skip_null_keys=True)


def unique_together(model: str, *columns: str) -> Check:
    return KeyCheck(model, f"unique_combination_{'_'.join(columns)}", columns)


def _listed(values: Sequence[str | int]) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def accepted_values(model: str, column: str, values: Sequence[str | int]) -> Check:
    return RowCheck(model, f"accepted_values_{column}", f"{column} NOT IN ({_listed(values)})")


def at_least_zero(model: str, column: str) -> Check:
    return RowCheck(model, f"accepted_range_{column}", f"{column} < 0", severity=WARN)


def has_parent(model: str, column: str, parent: str = "dim_team", parent_column: str = "team_id") -> Check:
    return ParentCheck(model, f"relationships_{column}_{parent}", column, parent, parent_column)


# A missing winner is not a contradiction.
WINNER_CONTRADICTS_SCORE = f"""
    match_status IN ({_listed(COUNTED_STATUSES)})
    AND winner <> CASE WHEN full_time_home_goals > full_time_away_goals THEN 'HOME_TEAM'
                       WHEN full_time_home_goals < full_time_away_goals THEN 'AWAY_TEAM'
                       WHEN full_time_home_goals = full_time_away_goals THEN 'DRAW' END"""

TEAM_SEASON = ("competition_code", "team_id", "season")

CHECKS: list[Check] = [
    *not_null("raw_competitions", "competition_code", "run_id"),
    *not_null("raw_teams", "competition_code", "run_id"),
    *not_null("raw_matches", "match_id", "competition_code", "season"),
    *not_null("raw_standings", "competition_code", "season"),
    *not_null("stg_competitions", "competition_code", "competition_id"),
    unique("stg_competitions", "competition_code"),
    *not_null("stg_teams", "team_id", "competition_code", "season"),
    *not_null("stg_matches", "match_id", "home_team_id", "away_team_id"),
    unique("stg_matches", "match_id"),
    accepted_values("stg_matches", "match_status", MATCH_STATUSES),
    at_least_zero("stg_matches", "full_time_home_goals"),
    at_least_zero("stg_matches", "full_time_away_goals"),
    *not_null("stg_standings", "team_id", "api_position", "points"),
    unique_together("int_match_team_performance", "match_id", "team_id"),
    *not_null("int_match_team_performance", "match_id", "team_id"),
    accepted_values("int_match_team_performance", "result", RESULTS),
    accepted_values("int_match_team_performance", "points", RESULT_POINTS),
    unique_together("int_table_progression", "competition_code", "team_id", "as_of_match_id"),
    *not_null("int_table_progression", "team_id", "competition_code", "league_position", "points"),
    *not_null("dim_team", "team_id", "team_name"),
    unique("dim_team", "team_id"),
    unique_together("dim_season", "competition_code", "season"),
    *not_null("dim_season", "season"),
    unique_together("dim_matchweek", "competition_code", "season", "matchweek"),
    *not_null("dim_date", "date_key"),
    unique("dim_date", "date_key"),
    *not_null("fact_match", "match_id", "home_team_id", "away_team_id"),
    unique("fact_match", "match_id"),
    has_parent("fact_match", "home_team_id"),
    has_parent("fact_match", "away_team_id"),
    unique_together("fact_team_match", "match_id", "team_id"),
    *not_null("fact_team_match", "team_id"),
    has_parent("fact_team_match", "team_id"),
    accepted_values("fact_team_match", "points", RESULT_POINTS),
    unique_together("fact_standing_snapshot", "competition_code", "season", "matchweek", "team_id"),
    *not_null("fact_standing_snapshot", "team_id", "league_position"),
    has_parent("fact_standing_snapshot", "team_id"),
    unique_together("mart_league_table", *TEAM_SEASON),
    *not_null("mart_league_table", "team_id", "league_position"),
    unique_together("mart_league_progression", *TEAM_SEASON, "matchweek"),
    unique_together("mart_team_form", "match_id", "team_id"),
    unique_together("mart_home_away_performance", *TEAM_SEASON),
    unique_together("mart_goal_analysis", *TEAM_SEASON),
    RowCheck("stg_matches", "home_team_not_away_team", "home_team_id = away_team_id"),
    KeyCheck("fact_team_match", "two_team_rows_per_match", ("match_id",), wrong="n <> 2"),
    RowCheck("fact_match", "winner_matches_score", WINNER_CONTRADICTS_SCORE),
]


# ---- counting ---------------------------------------------------------------------------------
#
# The row checks of a table are one aggregate without keys. Every key check groups the bare columns of its key: tasks
# combine rows first, so a key with very many rows is shuffled once a task, and a task holds the keys of one check only,
# of its part of one table.


def _broken_rows(table: DataFrame, checks: Mapping[int, RowCheck]) -> DataFrame:
    """check, failing: of all row checks of a table, read once."""
    counts = table.agg(*[F.count_if(F.expr(check.broken)).alias(f"c{number}") for number, check in checks.items()])
    found = [F.struct(F.lit(number).alias("check"), F.col(f"c{number}").alias("failing")) for number in checks]
    return counts.select(F.inline(F.array(*found)))


def _keyed(table: DataFrame, check: KeyCheck) -> DataFrame:
    """The wrong keys of a table, with their numbers of rows."""
    keyed = table.select(*check.columns)
    keyed = keyed.dropna() if check.skip_null_keys else keyed
    return keyed.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n")).filter(check.wrong)


def _wrong_keys(table: DataFrame, number: int, check: KeyCheck) -> DataFrame:
    return _keyed(table, check).agg(F.lit(number).alias("check"), F.count(F.lit(1)).alias("failing"))


def _orphans(table: DataFrame, parent: DataFrame, number: int, check: ParentCheck) -> DataFrame:
    """check, failing: child rows are counted by key before the keys meet their parents."""
    keys = table.select(F.col(check.column).alias("key")).where("key IS NOT NULL")
    counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(check.parent_column).alias("key"))
    return counted.join(parents, "key", "left_anti").agg(F.lit(number).alias("check"), F.sum("n").alias("failing"))


def _failing(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """check, failing: a row for every check; null failing is none."""
    of_rows: dict[str, dict[int, RowCheck]] = {}
    found = []
    for number, check in enumerate(checks):
        if isinstance(check, RowCheck):
            of_rows.setdefault(check.model, {})[number] = check
        elif isinstance(check, KeyCheck):
            found.append(_wrong_keys(tables[check.model], number, check))
        else:
            found.append(_orphans(tables[check.model], tables[check.parent], number, check))
    found += [_broken_rows(tables[model], some) for model, some in of_rows.items()]
    return reduce(DataFrame.unionAll, found)


def quality_outcomes(tables: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS) -> DataFrame:
    """model_name, test_name, status, failing_row_count of every check."""
    counted = _failing(tables, checks)
    declared = F.array(*[
        F.struct(F.lit(i).alias("check"), F.lit(c.model).alias("model_name"), F.lit(c.name).alias("test_name"),
                 F.lit(c.severity).alias("severity"))
        for i, c in enumerate(checks)
    ])
    failing = F.coalesce("failing", F.lit(0).cast("long"))
    spark = counted.sparkSession
    # As many rows as there are checks on both sides.
    return spark.range(1).select(F.inline(declared)).join(F.broadcast(counted), "check", "left").select(
        "model_name", "test_name",
        F.when(failing == 0, PASS).otherwise(F.col("severity")).alias("status"),
        failing.alias("failing_row_count"),
    )


def failing_rows(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """The rows (or keys with their counts) behind one failing check."""
    table = tables[check.model]
    if isinstance(check, RowCheck):
        return table.filter(check.broken)
    if isinstance(check, KeyCheck):
        return _keyed(table, check)
    parents = tables[check.parent].select(F.col(check.parent_column).alias(check.column))
    return table.filter(F.col(check.column).isNotNull()).join(parents, check.column, "left_anti")


def quality_audit(outcomes: DataFrame, run_id: str, invocation_id: str, executed_at: Column) -> DataFrame:
    """Outcomes as rows of the audit table."""
    return outcomes.select(
        row_key(F.lit(invocation_id), F.col("model_name"), F.col("test_name")).alias("check_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(invocation_id).alias("dbt_invocation_id"),
        "model_name", "test_name", "status", "failing_row_count",
        executed_at.alias("executed_at"),
    )
