"""Counting fields that are there but not of the type they are read as.

Staging reads a field of another type as null, so that one bad value does not stop a load. Here such values
are counted beside those that are there: in the pass that lands a load, and per run over a RAW table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.functions.expressions import field
from leaguelake.plans.staging import COMPETITION_FIELDS, MATCH_FIELDS, OVERALL, STANDING_FIELDS, TEAM_FIELDS
from leaguelake.sources.schemas import FIELD_AUDIT

#: By dataset, the paths that are read and their types.
READ: dict[str, dict[str, str]] = {
    "competitions": dict(COMPETITION_FIELDS.values()),
    "teams": {"id": "bigint", **dict(TEAM_FIELDS.values())},
    "matches": {"id": "string", **dict(MATCH_FIELDS.values())},
    "standings": dict(STANDING_FIELDS.values()),
}


def _team_rows() -> Column:
    """The records in one RAW row of standings: the team rows of the tables that staging keeps."""
    tables = F.try_variant_get("raw_json", "$.standings", "array<variant>")
    overall = F.filter(tables, lambda t: field(t, "type") == OVERALL)
    rows = F.transform(overall, lambda t: F.coalesce(F.try_variant_get(t, "$.table", "array<variant>"), _none()))
    return F.flatten(rows)


def _none() -> Column:
    return F.array().cast("array<variant>")


def _counts(dataset: str) -> dict[str, tuple[Column, Column]]:
    """By path: in how many records of the rows it is there, and in how many of them not of its type.

    A RAW row is one record, but for standings. Without a lambda over it Spark generates code for all paths.
    """

    def there(record: Column, path: str) -> Column:
        value = F.try_variant_get(record, f"$.{path}", "variant")
        return value.isNotNull() & ~F.is_variant_null(value)

    def total(holds) -> Column:
        if dataset != "standings":
            return F.count_if(holds(F.col("raw_json")))
        return F.coalesce(F.sum(F.size(F.filter(team_rows, holds))), F.lit(0)).cast("long")

    def both(path: str, kind: str) -> tuple[Column, Column]:
        return total(lambda r: there(r, path)), total(lambda r: there(r, path) & field(r, path, kind).isNull())

    team_rows = F.coalesce(_team_rows(), _none())
    return {path: both(path, kind) for path, kind in READ[dataset].items()}


def metrics(dataset: str) -> dict[str, Column]:
    """The counts as aggregates to observe while the RAW rows of a load are written."""
    counts = _counts(dataset).items()
    return {f"{path}/{what}": c for path, both in counts for what, c in zip(("present", "mistyped"), both, strict=True)}


def of_load(spark: SparkSession, dataset: str, load_id: str, seen: Mapping[str, int], executed_at: Column) -> DataFrame:
    """The metrics of a load as rows of the audit table, one for each field; of a load without rows all are 0."""
    rows = [
        (dataset, load_id, path, kind, int(seen.get(f"{path}/present", 0)), int(seen.get(f"{path}/mistyped", 0)))
        for path, kind in READ[dataset].items()
    ]
    schema = "dataset string, load_id string, field string, wanted string, present long, mistyped long"
    return spark.createDataFrame(rows, schema).withColumn("executed_at", executed_at).select(*FIELD_AUDIT.names)


def by_run(raw: DataFrame, dataset: str) -> DataFrame:
    """dataset, run_id, field, wanted, present, mistyped over a RAW table: one scan, one aggregate."""
    counts = _counts(dataset)
    flat = [c.alias(f"c{i}") for i, c in enumerate(c for both in counts.values() for c in both)]
    lines = [
        F.struct(
            F.lit(path).alias("field"), F.lit(READ[dataset][path]).alias("wanted"),
            F.col(f"c{2 * i}").alias("present"), F.col(f"c{2 * i + 1}").alias("mistyped"),
        )
        for i, path in enumerate(counts)
    ]
    counted = raw.groupBy("run_id").agg(*flat)
    return counted.select(F.lit(dataset).alias("dataset"), "run_id", F.inline(F.array(*lines)))
