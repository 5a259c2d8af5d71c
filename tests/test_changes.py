from datetime import datetime

import pytest
from tests.helpers import rows

import documents as sample
from rungworks import schemas
from rungworks.operators import changes
from rungworks.plans import silver, worklists
from rungworks.sources.documents import read_documents

STATE = schemas.MATCH_HISTORY_CHECKPOINT


def _docs(spark, write_json, *files):
    paths = [write_json(name, document) for name, document in files]
    return read_documents(spark, paths, silver.LEGACY.document)


def _state(spark, *values):
    return spark.createDataFrame([(k, n, datetime(2026, 1, 1)) for k, n in values], STATE.schema)


def test_changed_players_from_the_newest_document_of_each_league(spark, write_json):
    docs = _docs(
        spark,
        write_json,
        ("legacy_ladders_raw_4_2026-03-06_0000.json", sample.legacy([(1, "Old", 99, 0)])),
        ("legacy_ladders_raw_4_2026-03-07_0000.json", sample.legacy([
            (1, "Ann", 6, 4), ("2", "Bob", 5, 0), (3, "Cid", 0, 0), (4, "Dan", 3, 3), (None, "Nil", 9, 9),
            (6, "NoRealm", 1, 1, None, 0), (7, "Fewer", 1, 1), (8, "NoWins", None, 4),
        ])),
        ("legacy_ladders_raw_5_2026-03-01_0000.json", sample.legacy([(1, "Ann", 6, 9, None, 2, 3), (9, "New", 1, 0)])),
    )
    state = _state(spark, (2, 5), (3, 0), (4, 5), (7, 9))
    got = worklists.changed_players(docs, state)
    assert rows(got, "character_id", "realm", "region", "current_games") == [
        (1, 1, 2, 15), (4, 1, 2, 6), (7, 1, 2, 2), (8, 1, 2, 4), (9, 1, 3 - 1, 1),
    ]


def test_summary_and_first_run(spark):
    counters = spark.createDataFrame([(1, 5), (2, 0), (3, 7)], "character_id INT, current_games BIGINT")
    assert rows(changes.change_summary(counters, STATE.empty(spark))) == [(3, 2, 1, True)]
    assert rows(changes.change_summary(counters, _state(spark, (1, 5), (9, 1)))) == [(3, 1, 2, False)]
    assert rows(changes.change_summary(counters.where("false"), _state(spark, (1, 5)))) == [(0, 0, 0, False)]


def test_state_advances_for_landed_keys_only(spark):
    landed = spark.createDataFrame([(1, 8), (3, 2)], "character_id INT, current_games BIGINT")
    state = _state(spark, (1, 5), (2, 4))
    got = changes.advance_state(state, landed, "2026-02-01 00:00:00")
    assert got.schema == STATE.schema
    new, old = datetime(2026, 2, 1), datetime(2026, 1, 1)
    assert rows(got) == [(1, 8, new), (2, 4, old), (3, 2, new)]
    assert rows(changes.advance_state(state, landed.where("false"), "2026-02-01 00:00:00")) == rows(state)


def test_ladder_worklist_of_the_newest_structure(spark, write_json):
    newer = sample.league()
    newer["tier"].reverse()
    docs = read_documents(
        spark,
        [
            write_json("league_raw_5_2026-03-01_0000.json", {"tier": [{"division": [{"ladder_id": 9}]}]}),
            write_json("league_raw_5_2026-03-02_0000.json", newer),
            write_json("league_raw_6_2026-03-01_0000.json", {"tier": [{"division": [{"ladder_id": 7}]}]}),
        ],
        silver.LEAGUE.document,
    )
    assert rows(worklists.ladder_worklist(docs)) == [
        (5, 0, "5520"), (5, 1, "5533"), (5, 2, "5547"), (5, 3, "5501"), (6, 0, "7"),
    ]


@pytest.mark.parametrize("counter", ["x", "12.5"])
def test_counters_that_are_no_numbers_raise(spark, write_json, counter):
    docs = _docs(spark, write_json, ("legacy_ladders_raw_4_2026-03-07_0000.json", sample.legacy([(1, "Ann", counter, 1)])))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        worklists.changed_players(docs, STATE.empty(spark)).collect()
