"""The provider's table against the derived one, three checks per team."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.functions.expressions import row_key

CHECKS = {
    "standings_position": ("api_position", "derived_position"),
    "standings_points": ("api_points", "derived_points"),
    "standings_goal_difference": ("api_goal_difference", "derived_goal_difference"),
}


class ReconciliationMismatch(Exception):
    """The provider's table and the derived one disagree."""


def _at_played(stg_standings: DataFrame) -> DataFrame:
    """The matchweek to compare with is the number of games the team has played."""
    return stg_standings.withColumn("matchweek", F.col("played_games"))


SNAPSHOT_KEY = ["competition_code", "team_id", "season", "matchweek"]


def reconciliation_detail(
    stg_standings: DataFrame, snapshots: DataFrame, teams: DataFrame, competition: str | None = None
) -> DataFrame:
    """Every stored provider row beside its derived row, all competitions unless one is named."""
    if competition is not None:
        stg_standings = stg_standings.filter(F.col("competition_code") == competition)
        snapshots = snapshots.filter(F.col("competition_code") == competition)
    provider = _at_played(stg_standings).select(
        *SNAPSHOT_KEY, "snapshot_date", "api_position",
        F.col("points").alias("api_points"),
        F.col("goal_difference").alias("api_goal_difference"),
    )
    derived = snapshots.select(
        *SNAPSHOT_KEY,
        F.col("league_position").alias("derived_position"),
        F.col("points").alias("derived_points"),
        F.col("goal_difference").alias("derived_goal_difference"),
    )
    return (
        provider.join(derived, SNAPSHOT_KEY)
        .join(teams.select("team_id", "team_name"), "team_id")
        .select(
            "competition_code", "season", "snapshot_date", "matchweek", "team_id", "team_name",
            "api_position", "derived_position", "api_points", "derived_points",
            "api_goal_difference", "derived_goal_difference",
        )
    )


def unmatched_standings(stg_standings: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Provider rows the join drops: no derived row at that number of games."""
    return _at_played(stg_standings).join(snapshots.select(*SNAPSHOT_KEY), SNAPSHOT_KEY, "left_anti")


def reconciliation_checks(detail: DataFrame) -> DataFrame:
    """One row per team and check; two nulls agree."""

    def check(name: str, source: str, derived: str) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            F.col(source).alias("source_value"),
            F.col(derived).alias("derived_value"),
        )

    long = detail.select(
        "competition_code", "season", "snapshot_date", F.col("team_id").cast("string").alias("entity_key"),
        F.inline(F.array(*[check(name, *columns) for name, columns in CHECKS.items()])),
    )
    return long.withColumn("is_match", F.col("source_value").eqNullSafe(F.col("derived_value")))


def reconciliation_audit(checks: DataFrame, run_id: str, executed_at: Column) -> DataFrame:
    """Every outcome, matches included, as rows of the audit table."""
    key = row_key(F.lit(run_id), *[F.col(c) for c in ("competition_code", "season", "snapshot_date", "check_name", "entity_key")])
    return checks.select(
        key.alias("reconciliation_id"),
        F.lit(run_id).alias("run_id"),
        "competition_code", "season", "check_name", "entity_key",
        F.parse_json(F.col("source_value").cast("string")).alias("source_value"),
        F.parse_json(F.col("derived_value").cast("string")).alias("derived_value"),
        "is_match",
        executed_at.alias("executed_at"),
    )


def reconciliation_summary(checks: DataFrame, unmatched: DataFrame) -> DataFrame:
    """Checks run, mismatches and provider rows without a counterpart, per competition."""
    compared = checks.groupBy("competition_code").agg(
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if(~F.col("is_match")).alias("mismatches"),
    )
    compared = compared.withColumn("rows_compared", F.expr(f"checks_run div {len(CHECKS)}"))
    dropped = unmatched.groupBy("competition_code").agg(F.count(F.lit(1)).alias("unmatched_rows"))
    counts = ["rows_compared", "checks_run", "mismatches", "unmatched_rows"]
    return (
        compared.join(dropped, "competition_code", "full")
        .na.fill(0, counts)
        .withColumn(
            "outcome",
            F.when(F.col("checks_run") == 0, "PASS (nothing compared)")
            .when(F.col("mismatches") == 0, "PASS")
            .otherwise("FAIL"),
        )
        .select("competition_code", *counts, "outcome")
    )


def mismatch_count(checks: DataFrame) -> int:
    return checks.filter(~F.col("is_match")).count()


def require_no_mismatch(checks: DataFrame) -> None:
    count = mismatch_count(checks)
    if count:
        raise ReconciliationMismatch(f"{count} of the reconciliation checks disagree")
