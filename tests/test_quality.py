from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from samples import match, raw_matches, rows

from leaguelake.plans import audit, facts, quality, reconcile, staging
from leaguelake.sources.schemas import DATA_QUALITY_AUDIT, RECONCILIATION_AUDIT


def test_there_are_sixty_seven_checks():
    kinds = {}
    for check in quality.CHECKS:
        kind = check.name.split("_")[0] if not check.name.startswith("unique_comb") else "combination"
        kinds[kind] = kinds.get(kind, 0) + 1
    assert len(quality.CHECKS) == 67
    assert len({(c.model, c.name) for c in quality.CHECKS}) == 67
    assert kinds == {"not": 38, "unique": 5, "combination": 11, "accepted": 6, "relationships": 4,
                     "home": 1, "two": 1, "winner": 1}


def outcome(tables, check):
    return tuple(quality.quality_outcomes(tables, [check]).select("status", "failing_row_count").first())


def test_each_kind_of_check(spark):
    table = spark.createDataFrame(
        [(1, "a", 5), (1, "b", -1), (None, "a", None), (None, "c", 0), (3, None, 7)], "k int, v string, n int"
    )
    parents = spark.createDataFrame([(1,), (None,)], "k int")
    tables = {"t": table, "p": parents}
    assert outcome(tables, quality.not_null("t", "k")[0]) == ("FAIL", 2)
    assert outcome(tables, quality.unique("t", "k")) == ("FAIL", 1)
    assert outcome(tables, quality.unique_together("t", "k", "v")) == ("PASS", 0)
    assert outcome(tables, quality.unique_together("t", "k")) == ("FAIL", 2)
    assert outcome(tables, quality.accepted_values("t", "v", ["a", "b"])) == ("FAIL", 1)
    assert outcome(tables, quality.at_least_zero("t", "n")) == ("WARN", 1)
    assert outcome(tables, quality.has_parent("t", "k", "p", "k")) == ("FAIL", 1)
    empty = {"t": table.limit(0), "p": parents}
    assert outcome(empty, quality.has_parent("t", "k", "p", "k")) == ("PASS", 0)
    assert outcome(empty, quality.not_null("t", "k")[0]) == ("PASS", 0)


@pytest.mark.parametrize(("game", "flagged"), [
    (match(1, 1, "2023-08-11", 1, 2, (2, 0), winner="AWAY_TEAM"), 1),
    (match(1, 1, "2023-08-11", 1, 2, (0, 2), winner="DRAW"), 1),
    (match(1, 1, "2023-08-11", 1, 2, (1, 1), winner="HOME_TEAM", status="AWARDED"), 1),
    (match(1, 1, "2023-08-11", 1, 2, (2, 0), winner=None), 0),
    (match(1, 1, "2023-08-11", 1, 2, (2, 0), winner="AWAY_TEAM", status="IN_PLAY"), 0),
    (match(1, 1, "2023-08-11", 1, 2, (2, 0)), 0),
])
def test_winner_must_match_the_score(spark, game, flagged):
    check = next(c for c in quality.CHECKS if c.name == "winner_matches_score")
    tables = {"fact_match": facts.fact_match(staging.stg_matches(raw_matches(spark, [game])))}
    assert outcome(tables, check)[1] == flagged
    assert quality.failing_rows(tables, check).count() == flagged


def test_row_checks_of_a_table_share_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(str(tmp_path / "t"))
    tables = {"t": spark.read.parquet(str(tmp_path / "t"))}
    plan = quality.quality_outcomes(tables, quality.not_null("t", "k", "v"))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1


def test_key_checks_group_the_bare_columns_of_one_check(spark):
    """Lines of all checks in one aggregate, keys spelt as text, spilled where a check's own keys do not."""
    hot = spark.range(1000).selectExpr("1L AS k", "'x' AS v").unionAll(
        spark.createDataFrame([(2, None), (2, None), (None, "x"), (None, "x"), (3, "y")], "k long, v string")
    )
    tables = {"t": hot, "p": spark.createDataFrame([(3,), (3,)], "k int")}
    checks = [quality.unique("t", "k"), quality.unique_together("t", "k", "v"), quality.has_parent("t", "k", "p", "k")]
    outcomes = quality.quality_outcomes(tables, checks)
    assert rows(outcomes, "test_name", "failing_row_count") == sorted([
        ("unique_k", 2), ("unique_combination_k_v", 3), ("relationships_k_p", 1002)
    ])
    plan = outcomes._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan and "Aggregate [k" in plan and "Aggregate [k#" in plan.replace("Aggregate [k#", "", 1)


def test_outcomes_are_kept(spark, lake):
    tables = {"t": spark.createDataFrame([(None,), (1,)], "k int")}
    outcomes = quality.quality_outcomes(tables, [*quality.not_null("t", "k"), quality.unique("t", "k")])
    moment = F.lit("2024-01-01 06:00:00").cast("timestamp_ntz")
    lake.append_audit("data_quality_audit", quality.quality_audit(outcomes, "run", "call-1", moment))
    kept = lake.audit("data_quality_audit")
    assert kept.columns == DATA_QUALITY_AUDIT.names
    assert kept.select("check_id").distinct().count() == 2
    assert tuple(audit.quality_summary(kept).first()) == (2, 1)


DETAIL = ("competition_code string, season string, snapshot_date date, matchweek int, team_id int, team_name string, "
          "api_position int, derived_position int, api_points int, derived_points int, api_goal_difference int, "
          "derived_goal_difference int")


def checks(spark, *rows_):
    data = [("PL", "2023", None, 38, 65, "Manchester City FC", *r) for r in rows_]
    return reconcile.reconciliation_checks(spark.createDataFrame(data, DETAIL))


@pytest.mark.parametrize(("given", "mismatches"), [
    ([], 0),
    ([(1, 1, 91, 91, 62, 62)], 0),
    ([(1, 1, 91, 88, 62, 62)], 1),
    ([(1, 2, 91, 88, 62, 60)], 3),
    ([(None, None, 91, 91, 62, None)], 1),
])
def test_reconciliation(spark, lake, given, mismatches):
    found = checks(spark, *given)
    assert found.count() == 3 * len(given)
    assert reconcile.mismatch_count(found) == mismatches
    moment = F.lit("2024-01-01 06:00:00").cast("timestamp_ntz")
    lake.append_audit("reconciliation_audit", reconcile.reconciliation_audit(found, "run", moment))
    kept = lake.audit("reconciliation_audit")
    assert kept.columns == RECONCILIATION_AUDIT.names
    assert kept.count() == 3 * len(given) and kept.filter("not is_match").count() == mismatches
    if mismatches:
        with pytest.raises(reconcile.ReconciliationMismatch):
            reconcile.require_no_mismatch(found)
    else:
        reconcile.require_no_mismatch(found)


def test_run_states(spark):
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 1, 1)
    runs = spark.createDataFrame(
        [("a", "matches", 5, 4, 1), ("b", "teams", 0, 0, 0), ("c", "teams", 0, 0, 0)],
        "run_id string, dataset string, records_received long, records_inserted long, records_rejected long",
    ).select("*", F.lit("p").alias("pipeline_name"), F.lit("s").alias("source"), F.lit("PL").alias("competition_code"),
             F.lit("2023").alias("season"), F.lit(start).cast("timestamp_ntz").alias("started_at"))
    done = F.lit(end).cast("timestamp_ntz")
    log = (
        audit.started(runs)
        .unionByName(audit.succeeded(runs.filter("run_id = 'a'"), done))
        .unionByName(audit.failed(runs.filter("run_id = 'b'"), done, F.lit("e" * 5000)))
    )
    state = audit.run_state(log)
    assert rows(state, "run_id", "status", "records_inserted") == [("a", "SUCCESS", 4), ("b", "FAILED", None),
                                                                   ("c", "RUNNING", None)]
    assert state.filter("run_id = 'b'").select(F.length("error_message")).first()[0] == 4000
    assert rows(audit.loaded_units(state)) == [("matches", "PL", "2023")]
    summary = audit.success_rate(audit.run_summary(state))
    assert tuple(summary.first()) == (3, 1, 1, 4, end, 33.3)
    assert [r.run_id for r in audit.recent_runs(state, 2).collect()] == ["c", "b"]
