"""Table contracts: the columns, types and partitioning of every stored RAW and AUDIT table."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, BOOL = T.StringType(), T.LongType(), T.BooleanType()
DATE, NTZ, VARIANT = T.DateType(), T.TimestampNTZType(), T.VariantType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


RAW_COMPETITIONS = _struct(
    ("competition_code", STRING, False),
    ("run_id", STRING, False),
    ("source", STRING, False),
    ("loaded_at", NTZ, False),
    ("arrival", STRING, True),
    ("raw_json", VARIANT, False),
)
RAW_TEAMS = _struct(
    ("competition_code", STRING, False),
    ("season", STRING, True),
    ("run_id", STRING, False),
    ("source", STRING, False),
    ("loaded_at", NTZ, False),
    ("arrival", STRING, True),
    ("raw_json", VARIANT, False),
)
RAW_MATCHES = _struct(
    ("competition_code", STRING, False),
    ("season", STRING, False),
    ("matchweek", STRING, True),
    ("match_id", STRING, False),
    ("run_id", STRING, False),
    ("source", STRING, False),
    ("loaded_at", NTZ, False),
    ("arrival", STRING, True),
    ("raw_json", VARIANT, False),
)
RAW_STANDINGS = _struct(
    ("competition_code", STRING, False),
    ("season", STRING, False),
    ("snapshot_date", DATE, False),
    ("run_id", STRING, False),
    ("source", STRING, False),
    ("loaded_at", NTZ, False),
    ("arrival", STRING, True),
    ("raw_json", VARIANT, False),
)
RAW_REJECTS = _struct(
    ("dataset", STRING, False),
    ("competition_code", STRING, True),
    ("season", STRING, True),
    ("run_id", STRING, True),
    ("source", STRING, True),
    ("loaded_at", NTZ, True),
    ("reason", STRING, False),
    ("payload", STRING, True),
)

# One row per state change of a run. The current state of a run is its latest event.
RUN_EVENTS = _struct(
    ("run_id", STRING, False),
    ("pipeline_name", STRING, False),
    ("dataset", STRING, False),
    ("source", STRING, False),
    ("competition_code", STRING, True),
    ("season", STRING, True),
    ("matchweek", STRING, True),
    ("watermark", NTZ, True),
    ("started_at", NTZ, False),
    ("completed_at", NTZ, True),
    ("records_received", LONG, True),
    ("records_inserted", LONG, True),
    ("records_updated", LONG, True),
    ("records_rejected", LONG, True),
    ("status", STRING, False),
    ("error_message", STRING, True),
)
DATA_QUALITY_AUDIT = _struct(
    ("check_id", STRING, False),
    ("run_id", STRING, True),
    ("dbt_invocation_id", STRING, True),
    ("model_name", STRING, False),
    ("test_name", STRING, False),
    ("status", STRING, False),
    ("failing_row_count", LONG, True),
    ("executed_at", NTZ, False),
)
RECONCILIATION_AUDIT = _struct(
    ("reconciliation_id", STRING, False),
    ("run_id", STRING, True),
    ("competition_code", STRING, True),
    ("season", STRING, True),
    ("check_name", STRING, False),
    ("entity_key", STRING, True),
    ("source_value", VARIANT, True),
    ("derived_value", VARIANT, True),
    ("is_match", BOOL, False),
    ("executed_at", NTZ, False),
)

# How the fields of one load of a dataset fitted the types that staging reads them as.
FIELD_AUDIT = _struct(
    ("dataset", STRING, False),
    ("load_id", STRING, False),
    ("field", STRING, False),
    ("wanted", STRING, False),
    ("present", LONG, False),
    ("mistyped", LONG, False),
    ("executed_at", NTZ, False),
)

# What a payload file holds: one provider response per line, with what was asked for and when it came.
ENVELOPE = _struct(
    ("competition_code", STRING, True),
    ("season", STRING, True),
    ("fetched_at", STRING, True),
    ("payload", STRING, True),
)
#: Where the reader puts a line that is no JSON object.
BROKEN_LINE = "_broken_line"

SCHEMAS = {
    "raw_competitions": RAW_COMPETITIONS,
    "raw_teams": RAW_TEAMS,
    "raw_matches": RAW_MATCHES,
    "raw_standings": RAW_STANDINGS,
    "raw_rejects": RAW_REJECTS,
    "pipeline_run_audit": RUN_EVENTS,
    "data_quality_audit": DATA_QUALITY_AUDIT,
    "reconciliation_audit": RECONCILIATION_AUDIT,
    "field_audit": FIELD_AUDIT,
}

# A load or an audit replaces only its own run_id, so repeating a run changes nothing.
UNIT = ("competition_code", "season")
PARTITIONS = {
    "raw_competitions": ("competition_code", "run_id"),
    "raw_teams": (*UNIT, "run_id"),
    "raw_matches": (*UNIT, "run_id"),
    "raw_standings": (*UNIT, "run_id"),
    "raw_rejects": ("dataset", "run_id"),
    "data_quality_audit": ("run_id",),
    "reconciliation_audit": ("run_id",),
    "field_audit": ("dataset", "load_id"),
}

# Fixed values of the provider's vocabulary.
MATCH_STATUSES = (
    "SCHEDULED", "TIMED", "IN_PLAY", "PAUSED", "FINISHED",
    "SUSPENDED", "POSTPONED", "CANCELLED", "AWARDED",
)
COUNTED_STATUSES = ("FINISHED", "AWARDED")
TABLE_STAGES = ("REGULAR_SEASON", "LEAGUE_STAGE", "GROUP_STAGE")
RESULTS = ("WIN", "DRAW", "LOSS")
RESULT_POINTS = (0, 1, 3)
DATASETS = ("teams", "matches", "standings")
DEFAULT_COMPETITION = "PL"
