"""Documents to analytic tables, run twice and once more with news."""

from datetime import datetime

from tests.helpers import rows

import documents as sample
from rungworks import schemas
from rungworks.plans import jobs, silver
from rungworks.sources import tables

AS_OF = "2025-11-03 10:00:00"


def test_from_documents_to_analytic_tables(spark, write_json, tmp_path):
    bronze, typed, gold = (str(tmp_path / d) for d in ("bronze", "silver", "gold"))

    def run(as_of=AS_OF):
        silver.ingest_all(spark, bronze, typed, as_of)
        jobs.build_all(spark, typed, gold, as_of)

    def table(t):
        return tables.read_table(spark, f"{gold}/{t.name}", t)

    def players():
        return tables.read_version(spark, f"{gold}/dim_players", schemas.DIM_PLAYERS)

    write_json("modern_ladders_raw_5_2025-11-02_1000.json", sample.modern())
    write_json("modern_ladders_raw_5_2025-11-02_1010.json", sample.modern())
    write_json("legacy_ladders_raw_5_2025-11-02_1000.json", sample.legacy())
    write_json("matches_all_history_2025-11-02_1500.json", sample.matches())
    write_json("matches_all_history_2025-11-02_1600.json", sample.match_without_map())
    run()
    first, second, third = (datetime(2025, 11, 2, *t) for t in ((13, 30, 45), (14, 16, 3), (14, 26, 3)))
    facts = schemas.FACT_MATCHES.schema.names[1:]
    nobody = (None, None, None, None)
    expected = [
        (first, "Salt Flats", "1v1", 30411, "WIN", "Protoss", "HIGH", 30977, "LOSS", "Terran", "HIGH"),
        (second, "Old Mill", "1v1", 30411, "LOSS", "Protoss", "HIGH", *nobody),
        (third, "Salt Flats", "1v1", 30411, "TIE", "Protoss", "HIGH", *nobody),
    ]
    assert sorted(rows(table(schemas.FACT_MATCHES), *facts), key=lambda r: r[0]) == expected

    def aside():
        return rows(tables.read_table(spark, f"{typed}/quarantine", schemas.QUARANTINE), "source", "violation")

    assert aside() == [("fact_matches", "map: null")]
    assert rows(players(), "character_id", "race", "display_name", "clan_tag") == [
        (30411, "Protoss", "Mira", "OAK"), (30977, "Terran", "Odo", None),
    ]
    assert table(schemas.FACT_MMR_TRACK).count() == 4
    assert rows(table(schemas.PLAYER_STATS_DAILY), "profile_id", "games", "wins", "losses", "win_rate") == [
        (30411, 3, 1, 1, 1 / 3), (30977, 1, 0, 1, 0.0), (31555, 1, 1, 0, 1.0),
    ]
    assert table(schemas.MMR_CHECKPOINTS).count() == 4
    assert rows(table(schemas.PLAYER_MMR_DAILY), "profile_id", "max_rating", "clan_tag") == [
        (30411, 3010, "OAK"), (30977, 2805, None),
    ]

    kept = [t for t in schemas.GOLD if t is not schemas.DIM_PLAYERS]
    before = {t.name: rows(table(t)) for t in kept}
    run()
    assert {t.name: rows(table(t)) for t in kept} == before

    assert aside() == [("fact_matches", "map: null")]

    # Mira picks up a second race and a new name: her matches lose their certainty.
    news = sample.modern()
    news[0]["data"]["team"][0]["member"][0]["played_race_count"].reverse()
    write_json("modern_ladders_raw_5_2025-11-03_0900.json", news)
    write_json("legacy_ladders_raw_5_2025-11-03_0900.json", sample.legacy([(30411, "Mirabel", 11, 7, "OAK")]))
    run("2025-11-04 10:00:00")
    got = {r.match_date: r for r in table(schemas.FACT_MATCHES).collect()}
    assert len(got) == 3 and {r.p1_race_confidence for r in got.values()} == {"LOW"}
    assert got[first].p2_race_confidence == "HIGH"
    mira = players().where("character_id = 30411 AND race = 'Protoss'").first()
    assert mira.display_name == "Mirabel" and [tuple(x) for x in mira.legacy_names] == [("Mira", "2025-11-04")]


def test_jobs_run_on_nothing(spark, tmp_path):
    jobs.build_all(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), AS_OF)
    found = tables.read_version(spark, f"{tmp_path}/gold/dim_players", schemas.DIM_PLAYERS)
    assert found.isEmpty()
