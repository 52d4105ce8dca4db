"""The orders feed landed in a lake, once per session and input folder."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.jobs import RAW_TABLES, AuditFailed, audit_lake
from leaguelake.plans.models import Models
from leaguelake.sources import orders_feed as feed
from leaguelake.sources import payloads
from leaguelake.sources.store import Lake, cut, session_folder
from leaguelake.streaming.arrivals import follow_inbox
from leaguelake.streaming.run_state import current_state


#: Responses repeat the names of their fields in every item.
INBOX_COMPRESSION = "gzip"


class Demo:
    """Each RAW table is landed on first use; models are stored on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.lake = Lake(spark, f"{session_folder(spark)}/lake-{uuid.uuid4().hex}")
        self._landed: dict[str, DataFrame] = {}
        self.audit_failures: list[str] = []
        self.models = Models(_LandingLake(self), calendar_of_matches=True)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def schedule(self) -> DataFrame:
        return cut(feed.schedule(self.table("orders")), "schedule")

    @cached_property
    def match_envelopes(self) -> DataFrame:
        return feed.match_envelopes(self.schedule)

    def envelopes(self, dataset: str) -> DataFrame:
        makers = {
            "competitions": feed.competition_envelopes,
            "teams": feed.team_envelopes,
            "standings": feed.standing_envelopes,
        }
        return self.match_envelopes if dataset == "matches" else makers[dataset](self.schedule)

    def raw(self, name: str) -> DataFrame:
        if name not in self._landed:
            dataset = name.removeprefix("raw_")
            self.lake.land(name, payloads.LANDERS[dataset](self.envelopes(dataset)).rows)
            self._landed[name] = self.lake.raw(name)
        return self._landed[name]

    @cached_property
    def run_events(self) -> DataFrame:
        """The run log, derived on read: it is a projection of one scan."""
        return feed.run_events(self.table("events"))

    @cached_property
    def streamed(self) -> Lake:
        """A second lake filled by the stream: the first loads arrive, then the second ones."""
        root = f"{session_folder(self.spark)}/stream-{uuid.uuid4().hex}"
        lake = Lake(self.spark, f"{root}/lake")
        for run_id, moment in feed.LOAD_TIMES.items():
            for dataset in payloads.LANDERS:
                arrived = self.envelopes(dataset).filter(F.col("run_id") == run_id)
                lines = arrived.select(F.lit(dataset).alias("dataset"), "competition_code", "season", "payload")
                lines.write.mode("append").json(f"{root}/inbox/{dataset}", compression=INBOX_COMPRESSION)
            query = follow_inbox(
                lake, f"{root}/inbox/*", f"{root}/checkpoint", clock=lambda m=moment: datetime.fromisoformat(m)
            )
            query.awaitTermination()
        return lake

    @cached_property
    def one_run(self) -> Lake:
        """A third lake: its stream finds both loads in one batch, the newer in the older files, and lines
        that cannot be used."""
        root = f"{session_folder(self.spark)}/one-run-{uuid.uuid4().hex}"
        lake = Lake(self.spark, f"{root}/lake")
        feed.unusable_lines(self.schedule).write.text(f"{root}/inbox/unusable")
        for run_id, moment in reversed(feed.LOAD_TIMES.items()):
            for dataset in payloads.LANDERS:
                lines = self.envelopes(dataset).filter(F.col("run_id") == run_id).select(
                    F.lit(dataset).alias("dataset"), "competition_code", "season", F.lit(moment).alias("fetched_at"), "payload"
                )
                lines.write.mode("append").json(f"{root}/inbox/{dataset}", compression=INBOX_COMPRESSION)
        query = follow_inbox(lake, f"{root}/inbox/*", f"{root}/checkpoint")
        query.awaitTermination()
        return lake

    def damaged_match_envelopes(self) -> DataFrame:
        """Both loads of every round, some of them spoiled."""
        first_match = F.get_json_object("payload", "$.matches[0].matchday").cast("long")
        return feed.damaged_envelopes(self.match_envelopes, first_match)

    def mistyped_matches(self) -> DataFrame:
        """The landed matches, with fields of another type in some rounds."""
        raw = self.raw("raw_matches")
        return raw.withColumn("raw_json", feed.mistyped(F.col("raw_json"), F.col("matchweek").cast("long")))

    @cached_property
    def folded_runs(self) -> DataFrame:
        """The state of all runs, folded after each of three loads of events."""
        lake = Lake(self.spark, f"{session_folder(self.spark)}/runs-{uuid.uuid4().hex}")
        turn = F.pmod(F.xxhash64("run_id"), F.lit(3))
        state = None
        for load in range(3):
            # The ends of some runs come one load after their start.
            own = F.when((F.col("status") == "RUNNING") | (turn == 2), turn).otherwise(turn + 1)
            lake.append_audit("pipeline_run_audit", self.run_events.filter(own == load))
            state = current_state(lake)
        return state

    @cached_property
    def audited(self) -> Lake:
        """A lake whose audits hold two runs over the stored models, the second of them made twice."""
        lake = Lake(self.spark, f"{session_folder(self.spark)}/audits-{uuid.uuid4().hex}")
        tables = {name: self.raw(name) for name in RAW_TABLES} | self.models.build()
        for run_id in ("audit-1", "audit-2", "audit-2"):
            try:
                audit_lake(lake, run_id, datetime.fromisoformat(feed.LOAD_TIMES[feed.SECOND_LOAD]), tables)
            except AuditFailed as error:
                self.audit_failures.append(str(error))
        return lake


class _LandingLake(Lake):
    """A lake that lands a RAW table when it is first read."""

    def __init__(self, demo: Demo) -> None:
        super().__init__(demo.spark, demo.lake.root)
        self._demo = demo

    def raw(self, name: str) -> DataFrame:
        return self._demo.raw(name)


_demos: dict[tuple[str, str], Demo] = {}


def demo(spark: SparkSession, folder: str) -> Demo:
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _demos:
        _demos[key] = Demo(spark, folder)
    return _demos[key]
