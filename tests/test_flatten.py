from datetime import date, datetime

import pytest
from tests.helpers import rows

import documents as sample
from rungworks import schemas
from rungworks.operators import flatten
from rungworks.plans import silver
from rungworks.sources.documents import read_documents


def test_league_gives_one_row_per_division(spark, write_json):
    path = write_json("league_raw_5_2026-03-07_0440.json", sample.league())
    got = silver.LEAGUE.transform(read_documents(spark, path, schemas.LEAGUE_DOCUMENT))
    assert got.columns == schemas.LEAGUE_DIVISIONS.payload
    assert rows(got, "ladder_id", "tier_id", "tier_min_rating", "division_id", "season_id", "league_id") == [
        (5501, 6, 2900, 61, 81, 2), (5520, 7, 2750, 71, 81, 2),
        (5533, 7, 2750, 72, 81, 2), (5547, 7, 2750, 73, 81, 2),
    ]
    assert {r.snapshot_ts for r in got.collect()} == {datetime(2026, 3, 7, 4, 40)}


def test_modern_ladder_gives_one_row_per_member(spark, write_json):
    path = write_json("modern_ladders_raw_2026-03-07_0440.json", sample.modern())
    got = silver.MODERN.transform(read_documents(spark, path, schemas.MODERN_LADDER_DOCUMENT))
    assert got.columns == schemas.MODERN_LADDER_TEAMS.payload
    columns = ("character_id", "ladder_id", "team_id", "rating", "primary_race", "primary_race_count", "league_id")
    assert rows(got, *columns) == [
        (30411, 5501, "17000000000000000001", 3010, "Protoss", 12, 4),
        (30977, 5520, "44", 2805, "Terran", 9, 4),
        (None, 5501, None, None, None, None, 4),
    ]


def test_legacy_ladder_gives_one_row_per_member(spark, write_json):
    path = write_json("legacy_ladders_raw_6_2026-03-07_0440.json", sample.legacy())
    got = silver.LEGACY.transform(read_documents(spark, path, schemas.LEGACY_LADDER_DOCUMENT))
    assert got.columns == schemas.LEGACY_LADDER_MEMBERS.payload
    assert rows(got, "character_id", "display_name", "clan_tag", "league_id", "favorite_race") == [
        (30411, "Mira", "OAK", 6, "PROTOSS"), (30977, "Odo", None, 6, "PROTOSS"),
    ]


def test_match_history_gives_one_row_per_match(spark, write_json):
    path = write_json("matches_all_history_2026-03-08_0200.json", sample.matches())
    got = silver.MATCHES.transform(read_documents(spark, path, schemas.MATCH_HISTORY_DOCUMENT))
    assert sorted(got.columns) == sorted(schemas.MATCH_HISTORY.payload)
    assert rows(got, "profile_id", "match_date", "map", "decision", "snapshot_date") == [
        (30411, datetime(2025, 11, 2, 13, 30, 45), "Salt Flats", "WIN", date(2026, 3, 8)),
        (30411, datetime(2025, 11, 2, 14, 16, 3), "Old Mill", "LOSS", date(2026, 3, 8)),
        (30411, datetime(2025, 11, 2, 14, 26, 3), "Salt Flats", "TIE", date(2026, 3, 8)),
        (30977, datetime(2025, 11, 2, 13, 30, 45), "Salt Flats", "LOSS", date(2026, 3, 8)),
    ]


@pytest.mark.parametrize("flow", silver.FLOWS, ids=lambda f: f.kind)
@pytest.mark.parametrize("shape", ["empty", "missing", "null"])
def test_documents_without_rows_give_typed_empty_frames(spark, write_json, flow, shape):
    key = {"league_raw": "tier", "matches_all_history": "matches"}.get(flow.kind)
    if flow.kind == "league_raw":
        document = {"empty": {"key": {}, "tier": []}, "missing": {}, "null": {"key": None, "tier": None}}[shape]
    elif key:
        document = {"empty": [], "missing": [{"request_profile_id": 1}], "null": [{"matches": None}]}[shape]
    else:
        document = {"empty": [], "missing": [{"ladder_id": 1}], "null": [{"ladder_id": 1, "data": None}]}[shape]
    path = write_json(f"{flow.kind}_5_2026-03-07_0440.json", document)
    docs = read_documents(spark, path, flow.document)
    sound, broken = silver.prepare(flow, docs)
    assert sound.columns == flow.table.payload and sound.isEmpty() and broken.isEmpty()


def test_digits_as_text_pass_and_other_text_raises(spark, write_json):
    document = sample.league()
    document["tier"][0]["division"][0]["ladder_id"] = "many"
    path = write_json("league_raw_5_2026-03-07_0440.json", document)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.LEAGUE.transform(read_documents(spark, path, schemas.LEAGUE_DOCUMENT)).collect()


def test_flatten_path_with_position_and_prefixes(spark, write_json):
    path = write_json("league_raw_5_2026-03-07_0440.json", sample.league())
    docs = read_documents(spark, path, schemas.LEAGUE_DOCUMENT)
    got = flatten.flatten_path(
        docs,
        ["tier", "division"],
        meta={"min_rating": "tier.min_rating", "season_id": "key.season_id"},
        record_prefix="division_",
        meta_prefix="tier_",
        position="tier_index",
    )
    assert got.columns == [
        "division_id", "division_ladder_id", "division_member_count",
        "tier_min_rating", "tier_season_id", "tier_index",
    ]
    assert rows(got, "division_ladder_id", "tier_min_rating", "tier_season_id", "tier_index") == [
        ("5501", "2900", "81", 0), ("5520", "2750", "81", 1), ("5533", "2750", "81", 1), ("5547", "2750", "81", 1),
    ]


def test_child_ids_keep_document_order(spark, write_json):
    document = sample.league()
    document["tier"].insert(1, {"id": 9})
    path = write_json("league_raw_5_2026-03-07_0440.json", document)
    docs = read_documents(spark, path, schemas.LEAGUE_DOCUMENT)
    got = flatten.child_ids(docs, "tier", "division", "ladder_id", "ids")
    assert got.first()["ids"] == ["5501", "5520", "5533", "5547"]
    empty = read_documents(spark, write_json("league_raw_6_2026-03-07_0440.json", {}), schemas.LEAGUE_DOCUMENT)
    assert flatten.child_ids(empty, "tier", "division", "ladder_id", "ids").first()["ids"] == []
