"""Loading runs: what to load, landing it, and the audit trail of each (dataset, unit) run.

All units of a dataset are landed in one job. A response that fails validation is quarantined, its unit
is recorded as FAILED and left out of the datasets that follow; sound responses land, the other units go
on, and the call raises once everything is recorded. Lines that name no unit are quarantined as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.functions.expressions import row_key
from leaguelake.functions.seasons import check_range, current_season, utc_today
from leaguelake.plans import audit, field_types
from leaguelake.sources.payloads import (
    LANDERS, MATCH_WITHOUT_ID, Landing, load_time, read_envelopes, refused, unusable_lines,
)
from leaguelake.sources.schemas import DATASETS
from leaguelake.sources.store import Lake, cut
from leaguelake.streaming.run_state import current_state

SOURCE = "payload-files"
BACKFILL, DAILY = "leaguelake.backfill", "leaguelake.daily"
#: The run of lines that belong to none; a load replaces those that earlier loads found.
UNUSABLE = "unusable-lines"
RUN_KEY = ["dataset", "competition_code", "season"]


class IngestionFailed(Exception):
    """Some units were refused; their runs are recorded as FAILED. `work` is the whole work list of the load."""

    def __init__(self, message: str, work: DataFrame | None = None) -> None:
        super().__init__(message)
        self.work = work


# ---- planning -------------------------------------------------------------------------------


def requested_units(competitions: DataFrame, first: Column, current: Column) -> DataFrame:
    """Every (dataset, competition, season) from the first season through the current one."""
    seasons = competitions.filter(first <= current).select(
        "competition_code", F.explode(F.sequence(first, current)).alias("year"), current.alias("current")
    )
    return seasons.select(
        F.explode(F.array(*[F.lit(d) for d in DATASETS])).alias("dataset"),
        "competition_code",
        F.col("year").cast("string").alias("season"),
        (F.col("year") == F.col("current")).alias("is_current"),
    )


def work_list(requested: DataFrame, loaded: DataFrame, force: bool = False) -> DataFrame:
    """What is left to load: the current season always, an older one unless it is already loaded."""
    if force:
        return requested
    done = loaded.select(*[F.col(k).alias(f"done_{k}") for k in RUN_KEY])
    same = (
        (F.col("dataset") == F.col("done_dataset"))
        & (F.col("competition_code") == F.col("done_competition_code"))
        & (F.col("season") == F.col("done_season"))
    )
    return requested.join(done, same & ~F.col("is_current"), "left_anti")


# ---- loading --------------------------------------------------------------------------------


def stamp(envelopes: DataFrame, runs: DataFrame, keys: Sequence[str], moment: datetime) -> DataFrame:
    """Gives each response the run it belongs to; responses nobody asked for are left out."""
    return (
        envelopes.join(runs.select(*keys, "run_id"), list(keys))
        .withColumn("source", F.lit(SOURCE))
        .withColumn("loaded_at", load_time(_moment(moment)))
    )


def _moment(moment: datetime) -> Column:
    return F.lit(moment.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def _now() -> datetime:
    return datetime.now(UTC)


def _runs(work: DataFrame, pipeline_name: str, moment: datetime) -> DataFrame:
    """Run ids follow from what is run and when, so a repeated task names the same run."""
    key = row_key(F.lit(pipeline_name), *[F.col(k) for k in RUN_KEY], F.lit(moment.isoformat()))
    return work.select(
        key.alias("run_id"),
        F.lit(pipeline_name).alias("pipeline_name"),
        "dataset",
        F.lit(SOURCE).alias("source"),
        "competition_code",
        "season",
        _moment(moment).alias("started_at"),
    )


class MiscountedLoad(Exception):
    """The rows written are not those that the responses held."""


def land_counted(
    lake: Lake, dataset: str, rows: DataFrame, responses: DataFrame, load_id: str, moment: Column
) -> None:
    """Lands rows, counting them and the types of their fields in the same pass; the counts must agree.

    responses says how many rows came out of each; what is written is not read again.
    """
    counted = {"rows": F.count(F.lit(1)), **field_types.metrics(dataset)}
    seen = lake.land(f"raw_{dataset}", rows, counted)
    expected = responses.agg(F.coalesce(F.sum("items"), F.lit(0))).first()[0]
    if seen.get("rows", 0) != expected:
        raise MiscountedLoad(f"{seen.get('rows', 0)} {dataset} rows were written, the responses hold {expected}")
    lake.append_audit("field_audit", field_types.of_load(lake.spark, dataset, load_id, seen, moment))


def outcomes(responses: DataFrame) -> DataFrame:
    """run_id, records_inserted, records_rejected, reason (null unless a response was refused) of every run answered."""
    return responses.groupBy("run_id").agg(
        F.sum("items").alias("records_inserted"),
        F.count("reason").alias("records_rejected"),
        F.max(F.when(F.col("reason") != MATCH_WITHOUT_ID, F.col("reason"))).alias("reason"),
    )


def ends(runs: DataFrame, found: DataFrame, done: Column) -> DataFrame:
    """How each run ended, by its outcome."""
    counted = runs.join(found, "run_id", "left").na.fill(0, ["records_inserted", "records_rejected"])
    counted = counted.withColumn("records_received", F.col("records_inserted") + F.col("records_rejected"))
    good, bad = counted.filter("reason is null"), counted.filter("reason is not null")
    return audit.succeeded(good, done).unionByName(audit.failed(bad, done, F.col("reason")))


def _load_dataset(
    lake: Lake, dataset: str, runs: DataFrame, envelopes: DataFrame, keys: Sequence[str], moment: datetime
) -> DataFrame:
    """Lands one dataset and appends the end of every run. Returns the refused runs with reasons."""
    asked = stamp(envelopes, runs, keys, moment)
    landing: Landing = LANDERS[dataset](asked)
    responses = cut(landing.responses, "responses")
    lake.land("raw_rejects", refused(responses))
    silent = runs.join(responses.select("run_id").distinct(), "run_id", "left_anti").select(
        "run_id", F.lit(0).cast("long").alias("records_inserted"), F.lit(0).cast("long").alias("records_rejected"),
        F.lit("no response").alias("reason"),
    )
    found = cut(outcomes(responses).unionByName(silent), "outcomes")
    land_counted(lake, dataset, landing.rows, responses, moment.isoformat(), _moment(moment))
    lake.append_audit("pipeline_run_audit", ends(runs, found, _moment(_now())))
    faulty = found.filter("reason is not null").select("run_id", "reason")
    return runs.join(faulty, "run_id").select("competition_code", "season", "reason")


def _attempt(
    lake: Lake, dataset: str, runs: DataFrame, envelopes: DataFrame, keys: Sequence[str], moment: datetime
) -> DataFrame:
    lake.append_audit("pipeline_run_audit", audit.started(runs))
    lost = envelopes.withColumns({
        "run_id": F.lit(UNUSABLE), "source": F.lit(SOURCE), "loaded_at": load_time(_moment(moment)),
    })
    lake.land("raw_rejects", unusable_lines(lost, dataset))
    try:
        return _load_dataset(lake, dataset, runs, envelopes, keys, moment)
    except Exception as error:
        lake.append_audit("pipeline_run_audit", audit.failed(runs, _moment(_now()), F.lit(str(error))))
        raise


def load_metadata(
    lake: Lake, inbox: str, competition_codes: Sequence[str], pipeline_name: str, moment: datetime | None = None
) -> None:
    """Competition descriptions; never skipped."""
    moment = moment or _now()
    codes = lake.spark.createDataFrame([(c,) for c in competition_codes], "competition_code string")
    work = codes.select(
        F.lit("competitions").alias("dataset"), "competition_code", F.lit(None).cast("string").alias("season")
    )
    envelopes = read_envelopes(lake.spark, f"{inbox}/competitions")
    runs = cut(_runs(work, pipeline_name, moment), "runs")
    _raise_if_any(_attempt(lake, "competitions", runs, envelopes, ["competition_code"], moment))


def load_units(lake: Lake, inbox: str, work: DataFrame, pipeline_name: str, moment: datetime | None = None) -> None:
    """Teams, then matches, then standings of every unit on the list."""
    moment = moment or _now()
    runs = cut(_runs(work, pipeline_name, moment), "runs")
    keys = ["competition_code", "season"]
    failed = lake.spark.createDataFrame([], "competition_code string, season string, reason string")
    for dataset in DATASETS:
        due = runs.filter(F.col("dataset") == dataset).join(failed.select(*keys), keys, "left_anti")
        envelopes = read_envelopes(lake.spark, f"{inbox}/{dataset}")
        failed = failed.unionByName(_attempt(lake, dataset, cut(due, "due"), envelopes, keys, moment))
    _raise_if_any(failed, work)


def _raise_if_any(failed: DataFrame, work: DataFrame | None = None) -> None:
    count = failed.count()
    if count:
        r = failed.orderBy("competition_code", "season").first()
        example = f"{r.competition_code} {r.season or ''}: {r.reason}"
        raise IngestionFailed(f"{count} runs failed, as the run audit says one by one; the first is {example}", work)


def _loaded(lake: Lake) -> DataFrame:
    return audit.loaded_units(current_state(lake))


def _requested(lake: Lake, competition_codes: Sequence[str], first: int, today: date) -> DataFrame:
    last = current_season(today)
    check_range(first, last)
    codes = lake.spark.createDataFrame([(c,) for c in competition_codes], "competition_code string")
    return requested_units(codes, F.lit(first).cast("long"), F.lit(last).cast("long"))


def backfill(
    lake: Lake, inbox: str, competition_codes: Sequence[str], first_season: int,
    force: bool = False, today: date | None = None, moment: datetime | None = None,
) -> DataFrame:
    """Metadata, then every season up to the current one that is not loaded yet. Returns the work done."""
    requested = _requested(lake, competition_codes, first_season, today or utc_today())
    load_metadata(lake, inbox, competition_codes, BACKFILL, moment)
    work = cut(work_list(requested, _loaded(lake), force), "work")
    load_units(lake, inbox, work, BACKFILL, moment)
    return work


def daily(
    lake: Lake, inbox: str, competition_codes: Sequence[str], today: date | None = None, moment: datetime | None = None
) -> DataFrame:
    """Lands the current season only, always, without metadata. `jobs.daily` goes on to fresh marts and audits."""
    day = today or utc_today()
    work = cut(_requested(lake, competition_codes, current_season(day), day), "work")
    load_units(lake, inbox, work, DAILY, moment)
    return work
