"""Daily loading as a stream over the inbox: new payload files are picked up exactly once.

The trigger takes what is there and stops, so it runs as a scheduled batch. Every micro-batch lands its
sound responses, quarantines the others and every line without a usable envelope, records a run for
each dataset and unit, and rebuilds the units it touched. A batch repeated after a failure has the same
run ids and replaces what it wrote before. Which response is the newest does not depend on where
batches are cut: each carries its own time. What a batch holds on disk besides the stored tables goes with it, the copy
of its responses before the models are built, shuffle files as steps end.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from leaguelake.functions.expressions import row_key
from leaguelake.plans import audit
from leaguelake.plans.refresh import refresh, touched_units
from leaguelake.sources import ingest
from leaguelake.sources.payloads import (
    LANDERS, envelope_schema, load_time, refused, unusable, unusable_lines, with_line, with_place,
)
from leaguelake.sources.schemas import BROKEN_LINE
from leaguelake.sources.store import Lake, cut, let_go, scratch

ARRIVAL = envelope_schema(T.StructField("dataset", T.StringType()))
SOURCE = "payload-stream"
PIPELINE = "leaguelake.stream"


def _runs(arrivals: DataFrame) -> DataFrame:
    return arrivals.select(
        "run_id", F.lit(PIPELINE).alias("pipeline_name"), "dataset", "source", "competition_code", "season",
        F.col("batch_time").alias("started_at"),
    ).distinct()


def land_batch(lake: Lake, name: str, clock: Callable[[], datetime]) -> Callable[[DataFrame, int], None]:
    def now() -> Column:
        return F.lit(clock().replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch(lake.spark) as kept:
            with scratch(lake.spark):  # the copy of all responses goes before the models are built
                touched = cut(land(batch, batch_id), "touched", folder=kept)
            let_go(lake.spark)
            refresh(lake, touched)

    def land(batch: DataFrame, batch_id: int) -> DataFrame:
        moment, run = now(), f"{name}-{batch_id:08d}"
        why = unusable(F.col("dataset"))
        own_run = F.concat(F.lit(f"{run}-"), row_key(*map(F.col, ("dataset", "competition_code", "season"))))
        stamped = cut(
            with_line(batch)
            .withColumn("run_id", F.when(why.isNull(), own_run).otherwise(run))
            .withColumn("usable", why.isNull())
            .withColumn("source", F.lit(SOURCE))
            .withColumn("batch_time", moment)
            .withColumn("loaded_at", load_time(moment)),
            "arrivals",
        )
        lake.land("raw_rejects", unusable_lines(stamped, F.col("dataset")))
        usable = stamped.filter("usable")
        runs = cut(_runs(usable), "runs")
        lake.append_audit("pipeline_run_audit", audit.started(runs))
        for dataset, lander in LANDERS.items():
            landing = lander(usable.filter(F.col("dataset") == dataset))
            responses = cut(landing.responses, "responses")
            lake.land("raw_rejects", refused(responses))
            ingest.land_counted(lake, dataset, landing.rows, responses, run, moment)
            due = runs.filter(F.col("dataset") == dataset)
            lake.append_audit("pipeline_run_audit", ingest.ends(due, ingest.outcomes(responses), now()))
        return touched_units(usable)

    return write


def follow_inbox(
    lake: Lake,
    inbox: str,
    checkpoint: str,
    name: str = "arrivals",
    max_files: int = 10_000,
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
) -> StreamingQuery:
    """Starts a run over everything that has arrived: JSON lines with dataset, unit and payload."""
    reader = lake.spark.readStream.schema(ARRIVAL).option("columnNameOfCorruptRecord", BROKEN_LINE)
    arrivals = with_place(reader.option("maxFilesPerTrigger", max_files).json(inbox))
    return (
        arrivals.writeStream.queryName(name)
        .foreachBatch(land_batch(lake, name, clock))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
