"""Whole jobs, what they keep, and that they read no more than they need."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from samples import match, raw_matches, raw_standings, raw_teams, rows, standing
from test_ingest import EMPTY_TABLE, FIRST, SECOND, THIRD, TODAY, fill, stored_rows

from leaguelake import jobs
from leaguelake.plans import audit, field_types, match_index, serving
from leaguelake.plans.models import MODEL_NAMES, WAVES, Models
from leaguelake.sources import ingest, orders_feed, payloads, store
from leaguelake.streaming import run_state


def moved(inbox):
    """New results for 2024, and a match of 2023 that moves there."""
    inbox.put("matches", "PL", "2024", {"matches": [
        match(20242, 2, "2024-08-18", 2, 1, (3, 3)), match(20231, 3, "2024-08-25", 1, 2, (0, 1)),
        match(20232, 4, "2024-08-30", 1, 2, (0, 1)),
    ]})


# ---- daily ----------------------------------------------------------------------------------


def test_daily_ends_in_fresh_marts_and_kept_audits(lake, inbox):
    fill(inbox)
    first = jobs.backfill(lake, str(inbox), ["PL"], 2023, today=TODAY, moment=FIRST)
    assert first == {"tests": 67, "tests_failed": 0, "compared": 0, "mismatches": 0}
    moved(inbox)
    inbox.put("standings", "PL", "2024", {**EMPTY_TABLE, "standings": [{"stage": "REGULAR_SEASON", "type": "TOTAL", "table": [
        {**standing(1, 1, 3, 5, 4), "playedGames": 3},
    ]}]})
    with pytest.raises(jobs.AuditFailed, match="of 67 data tests and [1-3] of 3 reconciliation checks"):
        jobs.daily(lake, str(inbox), ["PL"], TODAY, SECOND)
    refreshed = stored_rows(lake)
    assert not [r for r in rows(lake.stored("marts", "mart_league_table"), "season") if r == ("2023",)]
    Models(lake).build()
    assert refreshed == stored_rows(lake)
    tests = lake.audit("data_quality_audit").groupBy("run_id").count()
    assert rows(tests, "count") == [(67,), (67,)]
    assert lake.audit("reconciliation_audit").count() == 3


def test_sound_units_reach_the_marts_before_a_refused_one_fails_the_job(lake, inbox):
    fill(inbox)
    inbox.put("matches", "PL", "2024", "{broken")
    with pytest.raises(ingest.IngestionFailed, match="PL 2024: payload is not JSON"):
        jobs.backfill(lake, str(inbox), ["PL"], 2023, today=TODAY, moment=FIRST)
    assert rows(lake.stored("marts", "mart_league_table"), "season", "team_name") == [("2023", "A"), ("2023", "B")]
    assert lake.audit("data_quality_audit").count() == 67


def test_waves_hold_every_model_once():
    assert sorted(name for wave in WAVES for name in wave) == sorted(MODEL_NAMES)


# ---- audits ---------------------------------------------------------------------------------


def _spoilt_tables(spark, lake, inbox):
    fill(inbox, ["2024"])
    ingest.daily(lake, str(inbox), ["PL"], TODAY, FIRST)
    Models(lake).build()
    tables = jobs.stored_tables(lake)
    return tables | {"stg_matches": tables["stg_matches"].unionByName(tables["stg_matches"])}


def test_a_repeated_audit_replaces_its_run_and_every_outcome_is_kept(spark, lake, inbox):
    tables = _spoilt_tables(spark, lake, inbox)
    for run_id, moment in (("a", FIRST), ("b", SECOND), ("b", THIRD)):
        with pytest.raises(jobs.AuditFailed, match=f"1 of 67 data tests and 0 of 0 reconciliation checks failed in {run_id}"):
            jobs.audit_lake(lake, run_id, moment, tables)
    kept = lake.audit("data_quality_audit")
    assert rows(kept.groupBy("run_id", "status").count(), "run_id", "status", "count") == [
        ("a", "FAIL", 1), ("a", "PASS", 66), ("b", "FAIL", 1), ("b", "PASS", 66)
    ]
    assert rows(kept.filter("status = 'FAIL'").select("test_name", "failing_row_count").distinct()) == [("unique_match_id", 2)]
    assert rows(kept.filter("run_id = 'b'").select("executed_at").distinct()) == [(THIRD,)]
    health = audit.pipeline_health(run_state.current_state(lake), kept).first()
    assert (health.data_quality.total_checks, health.data_quality.failed_checks) == (134, 2)
    assert health.summary.total_runs == len(health.recent_runs) == 3
    assert [r.started_at for r in health.recent_runs] == [FIRST] * 3
    assert [r.run_id for r in health.recent_runs] == sorted((r.run_id for r in health.recent_runs), reverse=True)


def test_health_of_an_empty_lake(lake):
    health = audit.pipeline_health(run_state.current_state(lake), lake.audit("data_quality_audit")).first()
    assert health.recent_runs == [] and health.summary.total_runs == 0 and health.data_quality.total_checks == 0


# ---- counts in the pass that writes ---------------------------------------------------------


def test_counts_come_from_the_pass_that_writes(lake, inbox, monkeypatch):
    """Landed rows are not read again, and a write that lost rows is found."""
    fill(inbox, ["2024"])
    monkeypatch.setattr(store.Lake, "raw", lambda *_: pytest.fail("landed rows are read"))
    ingest.daily(lake, str(inbox), ["PL"], TODAY, FIRST)
    monkeypatch.undo()
    ends = audit.run_state(lake.audit("pipeline_run_audit"))
    assert rows(ends, "dataset", "records_inserted") == [("matches", 2), ("standings", 1), ("teams", 2)]

    def losing(envelopes):
        landing = payloads.land_matches(envelopes)
        return payloads.Landing(landing.rows.limit(1), landing.responses)

    monkeypatch.setitem(ingest.LANDERS, "matches", losing)
    with pytest.raises(ingest.MiscountedLoad, match="1 matches rows were written, the responses hold 2"):
        ingest.daily(lake, str(inbox), ["PL"], TODAY, SECOND)
    state = audit.run_state(lake.audit("pipeline_run_audit")).filter("dataset = 'matches'")
    assert rows(state, "status") == [("FAILED",), ("SUCCESS",)]


# ---- fields of another type -----------------------------------------------------------------


def counted(raw, dataset):
    return {r.field: (r.present, r.mistyped) for r in field_types.by_run(raw, dataset).collect()}


def test_fields_of_another_type_are_counted(spark):
    sound = match(1, 1, "2023-08-11", 1, 2, (2, 0))
    odd = {**match(2, "later", "soon", 1, 2, (1, 1)), "homeTeam": [1], "score": {"winner": {"x": 1}, "fullTime": {"home": "2"}}}
    found = counted(raw_matches(spark, [sound, odd]), "matches")
    assert found["id"] == found["status"] == found["awayTeam.id"] == (2, 0)
    assert found["matchday"] == found["utcDate"] == (2, 1)
    assert found["homeTeam.id"] == (1, 0), "nothing there to be of a type"
    assert found["score.fullTime.home"] == (2, 0), "a number as text is read as a number"
    assert found["score.halfTime.home"] == (0, 0), "null is not there"
    assert found["score.winner"][0] == 2
    assert counted(raw_teams(spark, [{"id": "x", "founded": 1900.5}, {"founded": "old"}]), "teams")["founded"] == (2, 1)
    table = [standing(1, 1, 1, 3, 2), {**standing(2, 2, 1, 0, -2), "points": "none"}, "no object"]
    payload = {"standings": [{"stage": "S", "type": "TOTAL", "table": table}, {"type": "HOME", "table": table}, {"type": "TOTAL"}]}
    assert counted(raw_standings(spark, payload), "standings")["points"] == (2, 1)
    assert counted(raw_standings(spark, {"standings": 1}), "standings")["points"] == (0, 0)


def test_counting_fields_of_matches_needs_no_lambda(spark):
    raw = raw_matches(spark, [match(1, 1, "2023-08-11", 1, 2, (2, 0))])
    nothing = raw.withColumn("raw_json", F.lit(None).cast("variant"))
    assert counted(raw.unionByName(nothing), "matches")["id"] == (1, 0)
    assert "lambda" not in field_types.by_run(raw, "matches")._jdf.queryExecution().executedPlan().toString()


def test_rounds_that_are_not_spoilt_stay_as_they_are(spark):
    weeks = [*range(7), None]
    raw = raw_matches(spark, [match(i, week, "2023-08-11", 1, 2, (2, 0)) for i, week in enumerate(weeks)])
    spoilt = raw.withColumn("raw_json", orders_feed.mistyped(F.col("raw_json"), F.col("matchweek").try_cast("long")))
    changed = raw.select("match_id", F.to_json("raw_json").alias("a")).join(
        spoilt.select("match_id", F.to_json("raw_json").alias("b")), "match_id"
    ).filter("not a <=> b")
    assert set(rows(changed, "match_id")) == {("3",), ("4",), ("5",), ("6",)}


def test_a_load_records_the_types_of_its_fields(lake, inbox):
    fill(inbox, ["2024"])
    inbox.put("matches", "PL", "2024", {"matches": [{**match(1, 1, "2024-08-11", 1, 2, (2, 0)), "matchday": "later"}]})
    for _ in range(2):
        ingest.daily(lake, str(inbox), ["PL"], TODAY, FIRST)
    kept = lake.audit("field_audit")
    assert rows(kept.filter("mistyped > 0"), "dataset", "field", "wanted", "present", "mistyped") == [
        ("matches", "matchday", "bigint", 1, 1)
    ]
    read = sum(len(field_types.READ[d]) for d in ("teams", "matches", "standings"))
    assert kept.count() == read, "a repeated load replaces its counts"


# ---- the state of runs ----------------------------------------------------------------------


def _events(spark, found):
    """(run, status, minute it ended)"""
    end = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.lit(6), F.col("minute"), F.lit(0))
    df = spark.createDataFrame(found, "run_id string, status string, minute int")
    return df.select(
        "run_id", F.lit("p").alias("pipeline_name"), F.lit("teams").alias("dataset"), F.lit("s").alias("source"),
        F.lit("PL").alias("competition_code"), F.lit("2024").alias("season"), F.lit(None).cast("string").alias("matchweek"),
        F.lit(None).cast("timestamp_ntz").alias("watermark"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("started_at"),
        end.alias("completed_at"), *[F.lit(None).cast("long").alias(f"records_{n}") for n in ("received", "inserted", "updated", "rejected")],
        "status", F.lit(None).cast("string").alias("error_message"),
    )


def test_folded_state_equals_the_whole_log_after_every_load(spark, lake):
    loads = [
        [(f"r{i}", "RUNNING", None) for i in range(40)],
        [(f"r{i}", "SUCCESS", i) for i in range(0, 40, 2)] + [("late", "FAILED", 7)],
        [("r1", "FAILED", 3), ("r2", "FAILED", 1), ("late", "RUNNING", None), ("new", "RUNNING", None)],
    ]
    for load in loads:
        lake.append_audit("pipeline_run_audit", _events(spark, load))
        found = rows(run_state.current_state(lake))
        assert found == rows(audit.run_state(lake.audit("pipeline_run_audit")))
    assert dict((r[0], r[1]) for r in rows(run_state.current_state(lake), "run_id", "status"))["r2"] == "SUCCESS"


def test_a_fold_writes_nothing_but_the_state(spark, lake):
    cuts = f"{store.session_folder(spark)}/cuts"
    before = store.file_names(spark, cuts)
    for load in ([("a", "RUNNING", None), ("b", "RUNNING", None)], [("a", "SUCCESS", 3), ("a", "SUCCESS", 5), ("c", "RUNNING", None)]):
        lake.append_audit("pipeline_run_audit", _events(spark, load))
        state = run_state.current_state(lake)
    assert rows(state, "run_id", "status", F.minute("completed_at")) == [
        ("a", "SUCCESS", 5), ("b", "RUNNING", None), ("c", "RUNNING", None)
    ]
    assert store.file_names(spark, cuts) == before


def test_a_fold_touches_the_parts_of_its_events_only(spark, lake):
    lake.append_audit("pipeline_run_audit", _events(spark, [(f"r{i}", "RUNNING", None) for i in range(200)]))
    run_state.current_state(lake)
    path = lake.path("audit", run_state.STATE)

    def files():
        listed = spark.read.parquet(path).select("part", F.col("_metadata.file_path").alias("file"))
        return set(rows(listed.distinct(), "part", "file"))

    before = files()
    assert len({part for part, _ in before}) == run_state.PARTS
    lake.append_audit("pipeline_run_audit", _events(spark, [("r5", "SUCCESS", 9)]))
    state = run_state.current_state(lake)
    assert len(files() - before) == 1 and state.count() == 200
    assert rows(state.filter("run_id = 'r5'"), "status") == [("SUCCESS",)]


def test_nothing_is_loaded_where_nothing_ran(lake):
    assert run_state.current_state(lake).count() == 0
    assert audit.loaded_units(run_state.current_state(lake)).count() == 0


# ---- where matches are ----------------------------------------------------------------------


def _scanned(df):
    """Files that the scans of the executed plan read, by place."""
    df.collect()
    found = {}

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "FileSourceScanExec":
            found[node.relation().location().rootPaths().apply(0).toString()] = node.metrics().apply("numFiles").value()
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_the_index_reads_only_parts_that_hold_an_asked_match(spark, lake):
    staged = spark.range(3000).select(
        F.col("id").cast("string").alias("match_id"), F.lit("PL").alias("competition_code"),
        (2000 + F.col("id") % 20).cast("string").alias("season"),
    )
    lake.save_all_units("staging", "stg_matches", staged)
    assert match_index.located(lake, spark.createDataFrame([("17",), ("18",), ("x",)], "match_id string")).count() == 2
    folders = len(list(Path(lake.path("index", "match_units")).glob("part=*")))
    assert folders == match_index.PARTS

    def read(count):
        ids = spark.range(count).select(F.col("id").cast("string").alias("match_id"))
        df = match_index.located(lake, ids)
        assert "dynamicpruningexpression" in df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        return max(n for leaf, n in _scanned(df).items() if "match_units" in leaf)

    few, more = read(2), read(12)
    assert few <= 2 < more <= 12


def test_ids_of_matches_are_not_broadcast(spark, lake):
    """A file of them is far smaller than they are in memory, so that its size says nothing."""
    schema = "match_id string, competition_code string, season string"
    lake.save_all_units("staging", "stg_matches", spark.createDataFrame([("1", "PL", "2023")], schema))
    found = match_index.located(lake, spark.createDataFrame([("1",)], "match_id string"))
    assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 1


def test_the_index_follows_moved_matches(spark, lake):
    schema = "match_id string, competition_code string, season string"
    lake.save_all_units("staging", "stg_matches", spark.createDataFrame([("1", "PL", "2023"), ("2", "PL", "2023")], schema))
    ids = spark.createDataFrame([("1",), ("2",), ("3",)], "match_id string")
    assert rows(match_index.located(lake, ids), "match_id", "season") == [("1", "2023"), ("2", "2023")]
    match_index.update(lake, spark.createDataFrame([("1", "PL", "2024"), ("3", "PL", "2024")], schema))
    assert rows(match_index.located(lake, ids), "match_id", "season") == [("1", "2024"), ("2", "2023"), ("3", "2024")]
    match_index.update(lake, spark.createDataFrame([("1", "PL", "2024")], schema))
    assert match_index.located(lake, ids).count() == 3
    match_index.drop(lake)
    assert match_index.located(lake, ids).count() == 2


def test_only_folders_of_the_units_are_read(spark, lake):
    table = spark.range(400).select(
        F.concat(F.lit("C"), F.col("id") % 4).alias("competition_code"), (F.col("id") % 10).cast("string").alias("season"), "id"
    )
    stored = lake.save_all_units("marts", "t", table)
    units = store.cut(store.units_table(spark, [("C1", "1"), ("C1", "3"), ("C9", "1")]), "units")
    found = store.within(stored, units)
    assert [files for place, files in _scanned(found).items() if place.endswith("/marts/t")] == [2]
    wanted = [r.id for r in table.collect() if (r.competition_code, r.season) in {("C1", "1"), ("C1", "3")}]
    assert sorted(r.id for r in found.collect()) == wanted != []


# ---- large lists of ids ---------------------------------------------------------------------


def test_a_hundred_thousand_ids_are_a_table(spark):
    mart = spark.range(300).select(
        F.lit("PL").alias("competition_code"), F.lit("2023").alias("season"), F.col("id").alias("team_id"),
        F.lit(1).alias("matchweek"), F.lit(1).alias("league_position"), F.lit(3).alias("points"), F.lit(0).alias("position_change"),
    )
    teams = spark.range(300).select(F.col("id").alias("team_id"), F.concat(F.lit("T"), "id").alias("team_name"))

    def asked(ids):
        return serving.progression(mart, teams, "2023", "PL", ids)

    even = list(range(0, 200_000, 2))
    many = asked(even)
    assert [r.team_id for r in many.collect()] == list(range(0, 300, 2))
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and " IN " not in plan and "INSET" not in plan.upper() and len(plan) < 20_000
    assert rows(asked(spark.createDataFrame([(4,), (4,), (None,), (999,)], "team_id long")), "team_id") == [(4,)]
    assert asked([]).count() == asked(None).count() == 300
    assert asked(teams.limit(0).select("team_id")).count() == 0
