import json

import pytest
from tests.helpers import rows

import documents as sample
from rungworks.plans import bronze, silver
from rungworks.sources.documents import read_landed

AS_OF = "2026-03-07 04:40:00"


def test_sound_leagues_land_and_broken_ones_are_set_aside(spark, tmp_path):
    root = str(tmp_path / "bronze")
    responses = spark.createDataFrame(
        [(5, json.dumps(sample.league())), (6, '{"key": {}}'), (3, None)], "league_id INT, payload STRING"
    )
    broken = bronze.land_responses(bronze.LEAGUE, responses, root, AS_OF, "league_id")
    assert rows(broken, "league_id", "violation") == [
        (3, "payload is not an object"), (6, "key.season_id: missing"),
    ]
    sound, _ = bronze.checked_responses(bronze.LEAGUE, responses)
    assert rows(bronze.missing_partitions(sound, "league_id", [3, 4, 5, 6])) == [(3,), (4,), (6,)]
    divisions = silver.LEAGUE.transform(read_landed(spark, root, silver.LEAGUE.kind, silver.LEAGUE.document))
    assert rows(divisions, "ladder_id") == [(5501,), (5520,), (5533,), (5547,)]


def test_a_run_without_any_sound_payload_raises(spark, tmp_path):
    responses = spark.createDataFrame([(6, "{}")], "league_id INT, payload STRING")
    with pytest.raises(ValueError, match="no sound league_raw payload"):
        bronze.land_responses(bronze.LEAGUE, responses, str(tmp_path / "b"), AS_OF, "league_id")


@pytest.mark.parametrize("landing, flow, documents", [
    (bronze.MODERN, silver.MODERN, sample.modern()), (bronze.LEGACY, silver.LEGACY, sample.legacy()),
])
def test_ladders_are_wrapped_with_the_id_asked_for(spark, tmp_path, landing, flow, documents):
    root = str(tmp_path / "bronze")
    asked = [(4, d["ladder_id"], json.dumps(d["data"])) for d in documents] + [(4, 999, "{}")]
    responses = spark.createDataFrame(asked, "league_id INT, ladder_id BIGINT, payload STRING")
    broken = bronze.land_responses(landing, responses, root, AS_OF, "league_id")
    assert rows(broken, "ladder_id") == [(999,)]
    got = flow.transform(read_landed(spark, root, flow.kind, flow.document))
    assert {r.ladder_id for r in got.collect()} == {d["ladder_id"] for d in documents}
    assert {r.league_id for r in got.collect()} == {4}


def test_match_answers_carry_the_request_and_empty_ones_are_skipped(spark, tmp_path):
    root = str(tmp_path / "bronze")
    answers = [
        (d["request_profile_id"], 1, 2, json.dumps({"matches": d["matches"]})) for d in sample.matches()
    ] + [(5, 1, 2, '{"matches": {"a": 1}}')]
    responses = spark.createDataFrame(answers, "profile_id BIGINT, realm_id INT, region_id INT, payload STRING")
    broken = bronze.land_responses(bronze.MATCHES, responses, root, AS_OF)
    assert rows(broken, "profile_id", "violation") == [(5, "matches: list missing")]
    got = silver.MATCHES.transform(read_landed(spark, root, silver.MATCHES.kind, silver.MATCHES.document))
    assert rows(got, "profile_id", "region_id", "decision") == [
        (30411, 2, "LOSS"), (30411, 2, "TIE"), (30411, 2, "WIN"), (30977, 2, "LOSS"),
    ]
