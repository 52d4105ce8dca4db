"""The scheduled jobs: load, rebuild what the load touched, audit, and fail if anything was wrong."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.plans import quality, reconcile
from leaguelake.plans.models import MODEL_NAMES, layer_of
from leaguelake.plans.refresh import refresh, touched_units
from leaguelake.sources import ingest
from leaguelake.sources.store import Lake

RAW_TABLES = ("raw_competitions", "raw_teams", "raw_matches", "raw_standings")


class AuditFailed(Exception):
    """Some data tests or reconciliation checks failed; the audit tables say which."""


def stored_tables(lake: Lake) -> dict[str, DataFrame]:
    return {name: lake.raw(name) for name in RAW_TABLES} | {name: lake.stored(layer_of(name), name) for name in MODEL_NAMES}


def audit_lake(
    lake: Lake, run_id: str, moment: datetime | None = None, tables: dict[str, DataFrame] | None = None
) -> dict[str, int]:
    """Runs the data tests and the reconciliation, keeps every outcome under run_id, then raises if any failed.

    A run repeated under its id replaces its outcomes. How many failed is observed while they are written.
    Nothing to reconcile is no failure, but a warning.
    """
    tables = tables or stored_tables(lake)
    executed_at = F.lit((moment or datetime.now(UTC)).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    counted = F.count(F.lit(1))
    tests = lake.append_audit(
        "data_quality_audit",
        quality.quality_audit(quality.quality_outcomes(tables), run_id, run_id, executed_at),
        {"run": counted, "failed": F.count_if(F.col("status") == quality.FAIL)},
    )
    detail = reconcile.reconciliation_detail(tables["stg_standings"], tables["fact_standing_snapshot"], tables["dim_team"])
    compared = lake.append_audit(
        "reconciliation_audit",
        reconcile.reconciliation_audit(reconcile.reconciliation_checks(detail), run_id, executed_at),
        {"run": counted, "failed": F.count_if(~F.col("is_match"))},
    )
    found = {
        "tests": tests.get("run", 0), "tests_failed": tests.get("failed", 0),
        "compared": compared.get("run", 0), "mismatches": compared.get("failed", 0),
    }
    if not found["compared"]:
        warnings.warn("no provider row had a derived one to compare with", stacklevel=2)
    if found["tests_failed"] or found["mismatches"]:
        raise AuditFailed(
            f"{found['tests_failed']} of {found['tests']} data tests and {found['mismatches']} of "
            f"{found['compared']} reconciliation checks failed in {run_id}"
        )
    return found


def _load(lake: Lake, load, run_id: str, moment: datetime) -> dict[str, int]:
    """Sound units go all the way to the marts before refused ones make the job fail."""
    refused = None
    try:
        work = load()
    except ingest.IngestionFailed as error:
        refused, work = error, error.work
    refresh(lake, touched_units(work))
    found = audit_lake(lake, run_id, moment)
    if refused:
        raise refused
    return found


def daily(
    lake: Lake, inbox: str, competition_codes: Sequence[str], today: date | None = None, moment: datetime | None = None
) -> dict[str, int]:
    """Loads the current season, rebuilds what it touched and audits the lake."""
    moment = moment or datetime.now(UTC)
    return _load(
        lake, lambda: ingest.daily(lake, inbox, competition_codes, today, moment), f"daily-{moment.isoformat()}", moment
    )


def backfill(
    lake: Lake, inbox: str, competition_codes: Sequence[str], first_season: int,
    force: bool = False, today: date | None = None, moment: datetime | None = None,
) -> dict[str, int]:
    """Loads every season not loaded yet, rebuilds what that touched and audits the lake."""
    moment = moment or datetime.now(UTC)
    return _load(
        lake, lambda: ingest.backfill(lake, inbox, competition_codes, first_season, force, today, moment),
        f"backfill-{moment.isoformat()}", moment,
    )
