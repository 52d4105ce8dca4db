from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from samples import match, raw_matches, rows

from leaguelake.functions.expressions import field
from leaguelake.sources import payloads
from leaguelake.sources.schemas import SCHEMAS

LOADED = datetime(2024, 1, 1, 6)


def envelopes(spark, *texts):
    data = [("PL", "2023", "r1", "test", LOADED, t if isinstance(t, str) else json.dumps(t)) for t in texts]
    return spark.createDataFrame(
        data, "competition_code string, season string, run_id string, source string, loaded_at timestamp_ntz, payload string"
    )


GOOD = {
    "competitions": {"id": 4, "code": "PL", "name": "First League", "extra": {"kept": True}},
    "teams": {"count": 1, "teams": [{"id": 1, "name": "A"}]},
    "matches": {"matches": [{"id": 881, "matchday": 6}]},
    "standings": {"competition": {"code": "PL"}, "season": {"id": 1}, "standings": [{"stage": "X", "table": []}]},
}


@pytest.mark.parametrize("dataset", GOOD)
def test_a_sound_response_is_landed(spark, dataset):
    landing = payloads.LANDERS[dataset](envelopes(spark, GOOD[dataset]))
    assert landing.rows.columns == SCHEMAS[f"raw_{dataset}"].names
    assert landing.rows.count() == 1
    assert landing.rejects.count() == 0


@pytest.mark.parametrize(("dataset", "payload", "reason"), [
    ("competitions", {"number": 2}, "missing or malformed: id"),
    ("competitions", {"id": "x", "code": "PL", "name": "P"}, "missing or malformed: id"),
    ("competitions", {"id": 1.5, "code": "PL", "name": "P"}, "missing or malformed: id"),
    ("competitions", {"id": 1, "code": 7, "name": "P"}, "missing or malformed: code"),
    ("competitions", {"id": 1, "code": "PL"}, "missing or malformed: name"),
    ("teams", {"teams": []}, "missing or malformed: count"),
    ("teams", {"count": 1, "teams": {}}, "missing or malformed: teams"),
    ("teams", {"count": 1, "teams": [1]}, "missing or malformed: teams"),
    ("matches", {"count": 3}, "missing or malformed: matches"),
    ("matches", {"matches": [{"id": 1}, None]}, "missing or malformed: matches"),
    ("matches", "{broken", "payload is not JSON"),
    ("matches", "", "payload is not JSON"),
    ("standings", {"competition": {}, "season": 3, "standings": []}, "missing or malformed: season"),
    ("standings", {"competition": {}, "season": {}}, "missing or malformed: standings"),
])
def test_a_malformed_response_is_refused_whole(spark, dataset, payload, reason):
    landing = payloads.LANDERS[dataset](envelopes(spark, payload))
    assert landing.rows.count() == 0
    text = payload if isinstance(payload, str) else json.dumps(payload)
    assert rows(landing.rejects, "dataset", "reason", "payload") == [(dataset, reason, text)]


def test_an_empty_list_lands_nothing_and_is_no_fault(spark):
    landing = payloads.land_matches(envelopes(spark, {"count": 0, "matches": []}))
    assert landing.rows.count() == landing.rejects.count() == 0


def test_ids_and_matchdays_become_text(spark):
    payload = {"matches": [{"id": 881, "matchday": 6}, {"id": 2, "matchday": None}, {"id": 3}, {"matchday": 4}]}
    landing = payloads.land_matches(envelopes(spark, payload))
    assert rows(landing.rows, "match_id", "matchweek") == [("2", None), ("3", None), ("881", "6")]
    assert rows(landing.rejects, "reason", "payload") == [("match without id", '{"matchday":4}')]


def test_extra_keys_are_kept_and_teams_share_one_load_time(spark):
    kept = payloads.land_competitions(envelopes(spark, GOOD["competitions"])).rows
    assert kept.select(field("raw_json", "extra.kept", "boolean")).first()[0] is True
    teams = payloads.land_teams(envelopes(spark, {"count": 2, "teams": [{"id": 1}, {"id": 2}]})).rows
    assert rows(teams, field("raw_json", "id"), "loaded_at") == [("1", LOADED), ("2", LOADED)]


def test_a_standings_snapshot_carries_its_load_date(spark):
    found = payloads.land_standings(envelopes(spark, GOOD["standings"])).rows
    assert rows(found, "snapshot_date") == [(date(2024, 1, 1),)]


def test_each_payload_is_parsed_once(spark):
    plan = payloads.land_matches(envelopes(spark, GOOD["matches"])).rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_a_list_is_unpacked_once_and_no_schemas_of_its_items_are_built(spark):
    plan = payloads.land_matches(envelopes(spark, GOOD["matches"])).rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("$.matches") == 1 and "schemaOfVariant" not in plan


@pytest.mark.parametrize(("item", "sound"), [
    ({}, True), ({"id": None}, True), ({"id": {"x": [1]}}, True), ({"x": {"y": 1}}, True),
    ([], False), ([{"id": 1}], False), ("{}", False), (1, False), (1.5, False), (True, False), (None, False),
])
def test_what_is_an_object(spark, item, sound):
    landing = payloads.land_teams(envelopes(spark, {"count": 1, "teams": [{"id": 1}, item]}))
    assert landing.rows.count() == (2 if sound else 0) and landing.rejects.count() == (0 if sound else 1)


def test_match_filters(spark):
    games = [match(1, 1, "2023-08-11", 1, 2, (1, 0)), match(2, 2, "2023-08-18", 1, 2, status="TIMED"),
             match(3, 2, "2023-09-01", 3, 4, (0, 0))]
    raw = raw_matches(spark, games).unionByName(raw_matches(spark, [match(4, 2, "2022-08-18", 1, 2)], season="2022"))

    def ids(**filters):
        return [r[0] for r in rows(payloads.filter_matches(raw, **filters), "match_id")]

    assert ids() == ["1", "2", "3", "4"]
    assert ids(season="2023") == ["1", "2", "3"]
    assert ids(season="2023", matchday=2) == ["2", "3"]
    assert ids(status="TIMED") == ["2"]
    assert ids(date_from="2023-08-18", date_to="2023-08-31") == ["2"]
    assert payloads.filter_season(raw).count() == 4
    assert payloads.filter_season(raw, "2022").count() == 1


def test_envelope_files(spark, inbox):
    inbox.put("matches", "PL", "2023", GOOD["matches"])
    read = payloads.read_envelopes(spark, f"{inbox}/matches")
    assert rows(read, "competition_code", "season", "payload") == [("PL", "2023", json.dumps(GOOD["matches"]))]
    assert read.select(F.try_parse_json("payload").isNotNull()).first()[0]
