import json
from datetime import datetime

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

import documents as sample
from rungworks import schemas
from rungworks.operators import contracts
from rungworks.sources import documents


def check(spark, contract, *payloads):
    texts = [p if p is None or isinstance(p, str) else json.dumps(p) for p in payloads]
    df = spark.createDataFrame(list(enumerate(texts)), "n INT, payload STRING")
    checked = contracts.check_payloads(df, "payload", contract)
    return [r["violation"] for r in checked.orderBy("n").collect()]


def _without(document, *path):
    copy = json.loads(json.dumps(document))
    holder = copy
    for step in path[:-1]:
        holder = holder[step]
    del holder[path[-1]]
    return copy


def test_league_contract_names_the_first_violation(spark):
    sound = sample.league()
    cases = {
        "payload is not an object": [[], "7", "not json", None],
        "key: object missing": [{}, {"key": [], "tier": []}, {"key": None, "tier": []}],
        "tier: list missing": [_without(sound, "tier"), {**sound, "tier": None}, {**sound, "tier": {}}],
        "tier[1].division: list missing": [
            _without(sound, "tier", 1, "division"),
            {**sound, "tier": [sound["tier"][0], {"division": None}]},
            {**sound, "tier": [sound["tier"][0], 7]},
        ],
        "tier[1].division[2].ladder_id: missing": [_without(sound, "tier", 1, "division", 2, "ladder_id")],
    }
    for name in contracts.LEAGUE_KEY_FIELDS:
        cases[f"key.{name}: missing"] = [_without(sound, "key", name)]
    for expected, payloads in cases.items():
        assert check(spark, "league", *payloads) == [expected] * len(payloads)


def test_present_but_null_fields_pass_the_league_contract(spark):
    nulls = {"season_id": None, "queue_id": None, "league_id": None, "team_type": None}
    document = {"key": nulls, "tier": [{"division": [{"ladder_id": None}]}, {"division": []}]}
    assert check(spark, "league", sample.league(), document) == [None, None]


@pytest.mark.parametrize(
    "contract, name", [("modern_ladder", "team"), ("legacy_ladder", "ladderMembers"), ("match_history", "matches")]
)
def test_list_contracts(spark, contract, name):
    missing = f"{name}: list missing"
    payloads = [{name: []}, {name: [1]}, {}, {name: None}, {name: {}}, {name: "x"}, [], "nope", None]
    assert check(spark, contract, *payloads) == [None, None, missing, missing, missing, missing] + [
        "payload is not an object"
    ] * 3


def test_split_keeps_every_row_on_one_side(spark):
    df = spark.createDataFrame([(1, '{"team": []}'), (2, "{}")], "n INT, payload STRING")
    sound, broken = contracts.split(contracts.check_payloads(df, "payload", "modern_ladder"))
    assert rows(sound) == [(1, '{"team": []}')]
    assert rows(broken, "n", "violation") == [(2, "team: list missing")]


def test_empty_answers_are_left_out_before_the_contract(spark):
    texts = ['{"matches": []}', "{}", '{"matches": null}', '{"matches": [1]}', '{"matches": {"a": 1}}', None, "[]"]
    df = spark.createDataFrame(list(enumerate(texts)), "n INT, payload STRING")
    kept = contracts.without_empty_results(df, "payload", "matches")
    assert [r[0] for r in rows(kept, "n")] == [3, 4, 5, 6]


def test_require_any(spark):
    df = spark.range(1)
    assert contracts.require_any(df, "league") is df
    with pytest.raises(ValueError, match="no league to process"):
        contracts.require_any(df.where("id > 5"), "league")


def test_array_items_and_wrapping(spark, write_json):
    path = write_json("modern_ladders_raw_5_2026-03-07_0440.json", sample.modern())
    items = documents.array_items(documents.read_raw(spark, path))
    assert rows(items, "file_name", "position") == [
        ("modern_ladders_raw_5_2026-03-07_0440.json", 0), ("modern_ladders_raw_5_2026-03-07_0440.json", 1),
    ]
    payload = '{"matches": [{"date": 1}], "big": 18446744073709551615, "request_realm_id": 9}'
    df = spark.createDataFrame([(7, 1, payload)], "profile_id BIGINT, realm_id INT, payload STRING")
    out = documents.with_request_ids(df, ["profile_id", "realm_id"], "payload").first()["payload"]
    assert json.loads(out) == {
        "request_profile_id": 7, "request_realm_id": 1, "matches": [{"date": 1}], "big": 18446744073709551615,
    }
    wrapped = documents.with_key(df.withColumn("ladder_id", F.lit(5)), "ladder_id", "payload").first()["payload"]
    assert json.loads(wrapped) == {"ladder_id": 5, "data": json.loads(payload)}


def _divisions(spark, *values):
    names = schemas.LEAGUE_DIVISIONS.payload
    full = [tuple(dict(zip(("ladder_id", "snapshot_ts", "member_count"), v)).get(n) for n in names) for v in values]
    ddl = ", ".join(f"{n} {'TIMESTAMP_NTZ' if n == 'snapshot_ts' else 'BIGINT'}" for n in names)
    return spark.createDataFrame(full, ddl)


def test_constraint_report_and_quarantine(spark):
    at = datetime(2026, 1, 1)
    df = _divisions(
        spark, (1, at, 5), (1, at, 6), (1, at, 7), (None, at, 1), (2, None, 1), (3, at, 40000), (2**40, at, 1)
    )
    report = contracts.constraint_report(df, schemas.LEAGUE_DIVISIONS)
    assert rows(report) == [
        ("key: duplicate", 2), ("ladder_id: null", 1), ("ladder_id: out of range", 1),
        ("member_count: out of range", 1), ("snapshot_ts: null", 1),
    ]
    sound, broken = contracts.split(contracts.row_violation(df, schemas.LEAGUE_DIVISIONS))
    assert sound.count() == 3 and broken.count() == 4
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        schemas.LEAGUE_DIVISIONS.conform(df).collect()
