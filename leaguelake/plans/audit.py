"""The run log as events: a run starts, then succeeds or fails. Rows are only ever appended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.functions.expressions import bounded_message, count_when, percentage
from leaguelake.operators.latest import latest_per_key
from leaguelake.sources.schemas import RUN_EVENTS

RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
_IDENTITY = ("run_id", "pipeline_name", "dataset", "source", "competition_code", "season", "started_at")


def _event(runs: DataFrame, **columns: Column) -> DataFrame:
    empty = {
        f.name: F.lit(None).cast(f.dataType) for f in RUN_EVENTS.fields if f.name not in _IDENTITY and f.name not in columns
    }
    return runs.select(*_IDENTITY, *[c.alias(n) for n, c in {**empty, **columns}.items()]).select(*RUN_EVENTS.names)


def started(runs: DataFrame) -> DataFrame:
    return _event(runs, status=F.lit(RUNNING))


def succeeded(runs: DataFrame, completed_at: Column) -> DataFrame:
    """`runs` carries the counts records_received, records_inserted and records_rejected."""
    return _event(
        runs,
        status=F.lit(SUCCESS),
        completed_at=completed_at,
        records_received=F.col("records_received"),
        records_inserted=F.col("records_inserted"),
        records_rejected=F.col("records_rejected"),
    )


def failed(runs: DataFrame, completed_at: Column, message: Column) -> DataFrame:
    return _event(runs, status=F.lit(FAILED), completed_at=completed_at, error_message=bounded_message(message))


def run_state(events: DataFrame) -> DataFrame:
    """One row per run: its latest event. A run that never ended is still RUNNING."""
    newest = [F.col("completed_at").desc_nulls_last(), F.col("status").asc()]
    return latest_per_key(events, ["run_id"], newest)


def loaded_units(state: DataFrame) -> DataFrame:
    return state.filter(F.col("status") == SUCCESS).select("dataset", "competition_code", "season").distinct()


def recent_runs(state: DataFrame, limit: int = 20) -> DataFrame:
    return (
        state.select(
            "run_id", "pipeline_name", "dataset", "competition_code", "season", "status", "started_at",
            "completed_at", "records_received", "records_inserted", "records_rejected", "error_message",
        )
        .orderBy(F.col("started_at").desc_nulls_first(), F.col("run_id").desc())
        .limit(limit)
    )


def run_summary(state: DataFrame) -> DataFrame:
    good = F.col("status") == SUCCESS
    return state.agg(
        F.count(F.lit(1)).alias("total_runs"),
        count_when(good).alias("successful_runs"),
        count_when(F.col("status") == FAILED).alias("failed_runs"),
        F.sum("records_inserted").alias("total_records_inserted"),
        F.max(F.when(good, F.col("completed_at"))).alias("last_success_at"),
    )


def success_rate(summary: DataFrame) -> DataFrame:
    return summary.select("*", percentage(F.col("successful_runs"), F.col("total_runs")).alias("success_rate_pct"))


def quality_summary(quality_audit: DataFrame) -> DataFrame:
    return quality_audit.agg(
        F.count(F.lit(1)).alias("total_checks"),
        count_when(F.col("status") == "FAIL").alias("failed_checks"),
    )


def pipeline_health(state: DataFrame, quality_audit: DataFrame, limit: int = 20) -> DataFrame:
    """The health page in one row: recent_runs (newest first), summary, data_quality.

    state is one row per run, as stored or as `run_state` of the events gives it.
    """
    newest = recent_runs(state, limit)
    order = ["started_at", "run_id"]
    listed = newest.agg(F.reverse(F.array_sort(F.collect_list(F.struct(*order, *[c for c in newest.columns if c not in order]))))
                        .alias("recent_runs"))
    summary = success_rate(run_summary(state))
    checks = quality_summary(quality_audit)
    return (
        listed.crossJoin(summary.select(F.struct("*").alias("summary")))  # one row each
        .crossJoin(checks.select(F.struct("*").alias("data_quality")))
    )
