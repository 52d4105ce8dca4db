"""The state of all runs, kept up to date by folding in the events appended since.

The event log is a table that only grows, so it is read as a stream: every file of events is taken once, as
the stream's checkpoint says. The state is stored in parts by a hash of the run; a fold reads and replaces the
parts its events fall into and no others. Folding an event twice changes nothing, so a fold repeated after a failure
gives what one fold would have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leaguelake.plans import audit
from leaguelake.sources.schemas import RUN_EVENTS
from leaguelake.sources.store import Lake, exists, read_stored, write_partitioned

#: Parts of the state. For a long log: runs over some hundred thousand.
PARTS = 16
LOG, STATE = "pipeline_run_audit", "run_state"
STORED = T.StructType([*RUN_EVENTS.fields, T.StructField("part", T.IntegerType())])


def _state(lake: Lake) -> DataFrame:
    path = lake.path("audit", STATE)
    if not exists(lake.spark, path):
        return lake.spark.createDataFrame([], STORED)
    return read_stored(lake.spark, path, STORED)


def _fold(lake: Lake) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        part = F.pmod(F.xxhash64("run_id"), F.lit(PARTS)).cast("int")
        new = batch.withColumn("part", part).select(*STORED.names)
        # At most PARTS rows; the comparison lets Spark take them for selective and read their parts only.
        parts = new.select("part").distinct().filter(F.col("part") >= 0)
        known = _state(lake).join(F.broadcast(parts), "part", "left_semi").select(*STORED.names)
        # Parts are swapped when the whole write is done, so the state is read while its successor is written.
        folded = audit.run_state(known.unionByName(new))
        write_partitioned(folded, lake.path("audit", STATE), ["part"], keep_others=True)

    return write


def current_state(lake: Lake) -> DataFrame:
    """One row per run, its latest event, once all events appended so far are folded in."""
    log = lake.path("audit", LOG)
    if exists(lake.spark, log):
        events = lake.spark.readStream.schema(RUN_EVENTS).parquet(log)
        (
            events.writeStream.foreachBatch(_fold(lake))
            .option("checkpointLocation", lake.path("checkpoints", STATE))
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return _state(lake).select(*RUN_EVENTS.names)
