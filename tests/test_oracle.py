"""Every registered query against its DuckDB counterpart, and the rules that hold across models."""

from __future__ import annotations

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from leaguelake.plans import registry
from leaguelake.sources.demo import demo

FOLDER = "/root/testdata/sf0.001"
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(registry.QUERIES) == set(ORACLES) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches(spark, connection, name):
    assert compare.differences(contract.queries()[name](spark, FOLDER), connection, ORACLES[name]) == []


def test_rules_across_models(spark):
    models = demo(spark, FOLDER).models
    performance = models.int_match_team_performance
    per_match = performance.groupBy("match_id").agg(F.sum("points").alias("p"), F.sum("goal_difference").alias("d"))
    assert per_match.filter("p not in (2, 3) or d <> 0").count() == 0
    snapshots = models.fact_standing_snapshot
    assert snapshots.filter("played_games <> won + drawn + lost or points <> 3 * won + drawn").count() == 0
    sides = models.mart_home_away_performance.join(models.mart_goal_analysis, ["competition_code", "team_id", "season"])
    assert sides.filter("home_played + away_played <> played").count() == 0
