from __future__ import annotations

import json
import os
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from samples import match, rows, standing

from leaguelake.functions import seasons
from leaguelake.plans import audit, staging
from leaguelake.plans.models import MODEL_NAMES, Models
from leaguelake.plans.refresh import refresh, touched_units
from leaguelake.sources import ingest, store
from leaguelake.streaming.arrivals import follow_inbox

TODAY = date(2024, 9, 1)
FIRST, SECOND, THIRD = datetime(2024, 9, 1, 6), datetime(2024, 9, 2, 6), datetime(2024, 9, 3, 6)
EMPTY_TABLE = {"competition": {}, "season": {}, "standings": []}


def fill(inbox, seasons_=("2023", "2024"), competition="PL"):
    inbox.put("competitions", competition, None, {"id": 1, "code": competition, "name": competition})
    for season in seasons_:
        number = int(season) * 10
        inbox.put("teams", competition, season, {"count": 2, "teams": [{"id": 1, "name": "A"}, {"id": 2, "name": "B"}]})
        inbox.put("matches", competition, season, {"matches": [
            match(number + 1, 1, f"{season}-08-11", 1, 2, (2, 0)), match(number + 2, 2, f"{season}-08-18", 2, 1),
        ]})
        inbox.put("standings", competition, season, EMPTY_TABLE)


def states(lake, *columns):
    return rows(audit.run_state(lake.audit("pipeline_run_audit")), *columns)


def test_season_arithmetic():
    assert [seasons.current_season(date(2026, m, 1)) for m in (5, 6, 7, 8)] == [2025, 2025, 2026, 2026]
    seasons.check_range(2020, 2020)
    with pytest.raises(ValueError):
        seasons.check_range(2025, 2020)


def test_backfill_loads_every_season_then_only_the_current_one(lake, inbox):
    fill(inbox)
    first = ingest.backfill(lake, str(inbox), ["PL"], 2023, today=TODAY, moment=FIRST)
    assert rows(first, "dataset", "season") == [(d, s) for d in ("matches", "standings", "teams") for s in ("2023", "2024")]
    assert states(lake, "dataset", "season", "status", "records_received", "records_inserted", "records_rejected") == [
        ("competitions", None, "SUCCESS", 1, 1, 0),
        ("matches", "2023", "SUCCESS", 2, 2, 0), ("matches", "2024", "SUCCESS", 2, 2, 0),
        ("standings", "2023", "SUCCESS", 1, 1, 0), ("standings", "2024", "SUCCESS", 1, 1, 0),
        ("teams", "2023", "SUCCESS", 2, 2, 0), ("teams", "2024", "SUCCESS", 2, 2, 0),
    ]
    again = ingest.backfill(lake, str(inbox), ["PL"], 2023, today=TODAY, moment=SECOND)
    assert {r.season for r in again.collect()} == {"2024"}
    assert lake.raw("raw_competitions").count() == 2
    forced = ingest.backfill(lake, str(inbox), ["PL"], 2023, force=True, today=TODAY, moment=THIRD)
    assert forced.count() == 6
    assert lake.raw("raw_matches").count() == 10


def test_daily_takes_the_current_season_without_metadata(lake, inbox):
    fill(inbox)
    for moment in (FIRST, SECOND):
        assert {r.season for r in ingest.daily(lake, str(inbox), ["PL"], TODAY, moment).collect()} == {"2024"}
    assert lake.raw("raw_competitions").count() == 0
    assert rows(lake.raw("raw_matches"), "season", "loaded_at") == [("2024", FIRST)] * 2 + [("2024", SECOND)] * 2


def test_repeating_one_run_replaces_it(lake, inbox):
    fill(inbox)
    for _ in range(2):
        ingest.daily(lake, str(inbox), ["PL"], TODAY, FIRST)
    assert lake.raw("raw_matches").count() == 2
    assert len(states(lake, "run_id")) == 3


def test_a_refused_response_fails_its_unit_only(lake, inbox):
    fill(inbox)
    inbox.put("teams", "PL", "2024", {"number": 2})
    with pytest.raises(ingest.IngestionFailed, match="PL 2024: missing or malformed: count"):
        ingest.backfill(lake, str(inbox), ["PL"], 2023, today=TODAY, moment=FIRST)
    found = states(lake, "dataset", "season", "status", "error_message")
    assert ("teams", "2024", "FAILED", "missing or malformed: count") in found
    assert not [r for r in found if r[0] in ("matches", "standings") and r[1] == "2024"]
    assert ("standings", "2023", "SUCCESS", None) in found
    assert rows(lake.raw("raw_rejects"), "dataset", "season", "reason") == [
        ("teams", "2024", "missing or malformed: count")
    ]


def test_a_missing_response_fails_its_unit(lake, inbox):
    fill(inbox, ["2024"])
    with pytest.raises(ingest.IngestionFailed, match="PL 2023: no response"):
        ingest.backfill(lake, str(inbox), ["PL"], 2023, today=TODAY, moment=FIRST)


def test_a_match_without_id_is_counted_as_rejected(lake, inbox):
    fill(inbox, ["2024"])
    inbox.put("matches", "PL", "2024", {"matches": [match(1, 1, "2024-08-11", 1, 2), {"matchday": 2}]})
    ingest.daily(lake, str(inbox), ["PL"], TODAY, FIRST)
    assert ("matches", "SUCCESS", 2, 1, 1) in states(
        lake, "dataset", "status", "records_received", "records_inserted", "records_rejected"
    )


def test_a_broken_job_is_recorded_with_a_bounded_message(lake, inbox, monkeypatch):
    fill(inbox, ["2024"])

    def broken(*_):
        raise RuntimeError("x" * 5000)

    monkeypatch.setitem(ingest.LANDERS, "matches", broken)
    with pytest.raises(RuntimeError):
        ingest.daily(lake, str(inbox), ["PL"], TODAY, FIRST)
    found = {r[0]: r[1:] for r in states(lake, "dataset", "status", "error_message")}
    assert found["matches"] == ("FAILED", "x" * 4000)
    assert found["teams"] == ("SUCCESS", None)
    assert "standings" not in found


def test_first_season_after_the_current_one_is_refused(lake, inbox):
    with pytest.raises(ValueError):
        ingest.backfill(lake, str(inbox), ["PL"], 2030, today=TODAY)


def stored_rows(lake):
    return {
        name: rows(lake.stored(layer, name))
        for name in MODEL_NAMES if name != "dim_date"
        for layer in [{"stg": "staging", "int": "intermediate"}.get(name[:3], "marts")]
    }


def test_refresh_equals_a_full_rebuild(spark, lake, inbox):
    """New results, a renamed team and a match that moves to another season."""
    fill(inbox, ["2022", "2023", "2024"])
    inbox.put("standings", "PL", "2024", {**EMPTY_TABLE, "standings": [
        {"stage": "REGULAR_SEASON", "type": "TOTAL", "table": [standing(1, 1, 1, 3, 2)]}
    ]})
    ingest.backfill(lake, str(inbox), ["PL"], 2022, today=TODAY, moment=FIRST)
    Models(lake).build()

    inbox.put("teams", "PL", "2024", {"count": 2, "teams": [{"id": 1, "name": "A renamed"}, {"id": 2, "name": "B"}]})
    inbox.put("matches", "PL", "2024", {"matches": [
        match(20242, 2, "2024-08-18", 2, 1, (3, 3)), match(20231, 3, "2024-08-25", 1, 2, (0, 1)),
        match(20232, 4, "2024-08-30", 1, 2, (0, 1)),
    ]})
    work = ingest.daily(lake, str(inbox), ["PL"], TODAY, SECOND)
    refresh(lake, touched_units(work))
    refreshed = stored_rows(lake)
    names = rows(lake.stored("marts", "mart_league_table"), "season", "team_name")
    assert ("2022", "A renamed") in names
    assert not [r for r in names if r[0] == "2023"], "its only matches moved away"

    Models(lake).build()
    assert refreshed == stored_rows(lake)


def test_arrivals_are_picked_up_once(spark, lake, inbox, tmp_path):
    fill(inbox, ["2023"])
    checkpoint = str(tmp_path / "checkpoint")

    def run(moment):
        query = follow_inbox(lake, f"{inbox}/*", checkpoint, clock=lambda: moment)
        assert query.awaitTermination(300)
        assert query.exception() is None

    run(FIRST)
    assert rows(lake.stored("marts", "mart_league_table"), "season", "team_name", "points") == [
        ("2023", "A", 3), ("2023", "B", 0)
    ]
    inbox.put("matches", "PL", "2023", {"matches": [match(20232, 2, "2023-08-18", 2, 1, (1, 0))]}, name="b")
    inbox.put("matches", "PL", "2024", "{broken", name="b")
    run(SECOND)
    run(THIRD)
    assert lake.raw("raw_matches").count() == 3
    assert rows(lake.stored("marts", "mart_league_table"), "season", "team_name", "points") == [
        ("2023", "A", 3), ("2023", "B", 3)
    ]
    assert rows(lake.raw("raw_rejects"), "season", "reason") == [("2024", "payload is not JSON")]


@pytest.mark.parametrize("newer_first", [True, False])
@pytest.mark.parametrize("timed", [True, False])
def test_the_newest_of_two_responses_in_one_run_wins(spark, lake, inbox, tmp_path, newer_first, timed):
    """By the time it was fetched; without that, by the time of its file. Sizes of files do not matter."""
    fill(inbox, ["2024"])
    scored = {"matches": [match(1, 1, "2024-08-11", 1, 2, (2, 0)), *[match(100 + i, 2, "2024-08-12", 1, 2) for i in range(30)]]}
    early = {"matches": [match(1, 1, "2024-08-11", 1, 2)]}
    order = [("z", scored, "2024-08-12T06:00:00Z"), ("a", early, "2024-08-10T06:00:00Z")]
    for age, (name, payload, moment) in enumerate(order if newer_first else order[::-1]):
        inbox.put("matches", "PL", "2024", payload, name=name)
        file = inbox.folder / "matches" / f"{name}-PL-2024.json"
        if timed:
            file.write_text(json.dumps({**json.loads(file.read_text()), "fetched_at": moment}) + "\n")
        os.utime(file, (10**9 + age, 10**9 + age))
    expected = [(1, 2 if timed or not newer_first else None)]

    def found(lake):
        staged = staging.stg_matches(lake.raw("raw_matches")).filter("match_id = '1'")
        return [(int(r.match_id), r.full_time_home_goals) for r in staged.collect()]

    ingest.daily(lake, str(inbox), ["PL"], TODAY, FIRST)
    assert found(lake) == expected
    streamed = store.Lake(spark, str(tmp_path / "streamed"))
    assert follow_inbox(streamed, f"{inbox}/*", str(tmp_path / "cp"), clock=lambda: FIRST).awaitTermination(300)
    assert found(streamed) == expected


@pytest.mark.parametrize("stage", ["stg_matches", "int_match_team_performance", "fact_team_match", "mart_league_table"])
def test_a_refresh_repeated_after_a_failure_equals_a_full_rebuild(lake, inbox, monkeypatch, stage):
    """A match moves to another season; the refresh fails right after one of the tables was written."""
    fill(inbox, ["2023", "2024"])
    ingest.backfill(lake, str(inbox), ["PL"], 2023, today=TODAY, moment=FIRST)
    Models(lake).build()
    inbox.put("matches", "PL", "2024", {"matches": [match(20232, 4, "2024-08-30", 1, 2, (0, 1))]})
    work = ingest.daily(lake, str(inbox), ["PL"], TODAY, SECOND)
    save = store.Lake.save_units

    def failing(self, layer, name, *rest):
        result = save(self, layer, name, *rest)
        if name == stage:
            raise RuntimeError("lost")
        return result

    monkeypatch.setattr(store.Lake, "save_units", failing)
    with pytest.raises(RuntimeError, match="lost"):
        refresh(lake, touched_units(work))
    monkeypatch.setattr(store.Lake, "save_units", save)
    refresh(lake, touched_units(work))
    refreshed = stored_rows(lake)
    assert not store.exists(lake.spark, lake.path("refresh", "unfinished.json"))
    Models(lake).build()
    assert refreshed == stored_rows(lake)


UNUSABLE_LINES = [
    '{"dataset": "matches", "competition_code": "PL", "seas',
    json.dumps({"dataset": "referees", "competition_code": "PL", "season": "2023", "payload": "{}"}),
    json.dumps({"dataset": "matches", "season": "2023", "payload": "{}"}),
    json.dumps({"dataset": "matches", "competition_code": "PL", "payload": json.dumps({"matches": [match(9, 1, "2023-08-11", 1, 2)]})}),
]


def test_the_stream_quarantines_what_it_cannot_use_and_records_its_runs(lake, inbox, tmp_path):
    fill(inbox, ["2023"])
    (inbox.folder / "other").mkdir()
    (inbox.folder / "other" / "x.json").write_text("\n".join(UNUSABLE_LINES) + "\n")
    assert follow_inbox(lake, f"{inbox}/*", str(tmp_path / "cp"), clock=lambda: FIRST).awaitTermination(300)
    assert rows(lake.raw("raw_rejects"), "dataset", "reason") == [
        ("matches", "missing competition"), ("matches", "missing season"),
        ("referees", "unknown dataset"), ("unknown", "line is not JSON"),
    ]
    assert states(lake, "dataset", "season", "status", "records_received", "records_inserted", "records_rejected") == [
        ("competitions", None, "SUCCESS", 1, 1, 0), ("matches", "2023", "SUCCESS", 2, 2, 0),
        ("standings", "2023", "SUCCESS", 1, 1, 0), ("teams", "2023", "SUCCESS", 2, 2, 0),
    ]
    refreshed = stored_rows(lake)
    Models(lake).build()
    assert refreshed == stored_rows(lake)
    again = ingest.backfill(lake, str(inbox), ["PL"], 2023, today=date(2023, 9, 1), moment=SECOND)
    assert {r.season for r in again.collect()} == {"2023"}  # the current one, always
    later = ingest.work_list(
        ingest.requested_units(lake.spark.createDataFrame([("PL",)], "competition_code string"), F.lit(2023), F.lit(2024)),
        audit.loaded_units(audit.run_state(lake.audit("pipeline_run_audit"))),
    )
    assert {r.season for r in later.collect()} == {"2024"}


def test_batches_of_the_stream_leave_nothing_on_disk_but_stored_tables(spark, lake, inbox, tmp_path):
    cuts = f"{store.session_folder(spark)}/cuts"
    before = store.file_names(spark, cuts)
    for season in ("2023", "2024"):  # the first builds all models, the second replaces units
        fill(inbox, [season])
        assert follow_inbox(lake, f"{inbox}/*", str(tmp_path / "cp"), clock=lambda: FIRST).awaitTermination(300)
    assert store.file_names(spark, cuts) == before
    refreshed = stored_rows(lake)
    Models(lake).build()
    assert refreshed == stored_rows(lake)


def test_a_batch_load_quarantines_what_it_cannot_use(lake, inbox):
    fill(inbox, ["2024"])
    (inbox.folder / "matches" / "x.json").write_text("\n".join([UNUSABLE_LINES[0], UNUSABLE_LINES[2], UNUSABLE_LINES[3]]) + "\n")
    ingest.daily(lake, str(inbox), ["PL"], TODAY, FIRST)
    assert rows(lake.raw("raw_rejects"), "dataset", "reason") == [
        ("matches", "line is not JSON"), ("matches", "missing competition"), ("matches", "missing season"),
    ]


def test_unit_folders_of_any_name_are_replaced_and_emptied(spark, lake):
    units = [("A:B/1", "2023/24"), ("A:B/1", "2024 x")]
    first = spark.createDataFrame([(*units[0], 1), (*units[1], 2)], "competition_code string, season string, v int")
    lake.save_all_units("marts", "t", first)
    left = lake.save_units("marts", "t", first.filter("v = 2").withColumn("v", F.lit(3)), units)
    assert rows(left) == rows(lake.stored("marts", "t")) == [("A:B/1", "2024 x", 3)]


def test_a_cluster_must_name_its_shared_folder(spark):
    class Conf(dict):
        pass

    def session(master, **conf):
        context = SimpleNamespace(master=master, applicationId="app")
        return SimpleNamespace(conf=Conf(conf), sparkContext=context)

    assert store.shared_folder(session("yarn", **{"spark.checkpoint.dir": "hdfs://x/cp/"})) == "hdfs://x/cp"
    assert store.shared_folder(session("local[2]"))
    with pytest.raises(ValueError):
        store.shared_folder(session("yarn"))
