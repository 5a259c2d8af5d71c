import os
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from tests.helpers import rows

import documents as sample
from rungworks import schemas
from rungworks.plans import silver
from rungworks.session import scratch_path, shared_dir, stage, staging
from rungworks.sources import documents, tables

STATE = schemas.MATCH_HISTORY_CHECKPOINT


@pytest.mark.parametrize("table", [*schemas.SILVER, *schemas.GOLD], ids=lambda t: t.name)
def test_tables_start_empty_and_declare_their_keys(spark, tmp_path, table):
    path = str(tmp_path / table.name)
    assert tables.read_table(spark, path, table).isEmpty()
    tables.ensure_table(spark, path, table)
    tables.ensure_table(spark, path, table)
    assert tables.read_table(spark, path, table).schema.names == table.schema.names
    assert set(table.key) | set(table.required) <= set(table.schema.names)


def test_versions_skip_half_written_ones(spark, tmp_path):
    root = str(tmp_path / "state")

    def state(n):
        return spark.createDataFrame([(1, n, datetime(2026, 1, 1))], STATE.schema)

    assert tables.read_version(spark, root, STATE).isEmpty()
    tables.write_version(state(1), root)
    tables.write_version(state(2), root)
    os.remove(f"{root}/v000002/_SUCCESS")
    assert rows(tables.read_version(spark, root, STATE), "total_games") == [(1,)]
    assert tables.write_version(state(3), root).endswith("v000002")
    assert rows(tables.read_version(spark, root, STATE), "total_games") == [(3,)]


def test_replacing_days_leaves_the_others(spark, tmp_path):
    path, table = str(tmp_path / "t"), schemas.PLAYER_STATS_DAILY

    def stats(*days):
        return spark.createDataFrame([(1, date(2026, 1, d), g, 0, 0, 0.0) for d, g in days], table.schema)

    tables.append(stats((1, 1), (2, 2), (3, 3)), path, table)
    one = tables.read_table(spark, path, table, days=[date(2026, 1, 2)])
    assert rows(one, "games") == [(2,)] and one.columns == table.schema.names
    tables.replace_days(one.selectExpr("profile_id", "match_date", "games * 10 AS games", "wins", "losses", "win_rate"), path, table)
    assert rows(tables.read_table(spark, path, table), "games") == [(1,), (20,), (3,)]
    assert rows(tables.read_table(spark, path, table, since=date(2026, 1, 2)), "games") == [(20,), (3,)]
    assert tables.read_table(spark, path, table, days=[]).isEmpty()
    plan = tables.read_table(spark, path, table, days=[date(2026, 1, 2)])._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(day" in plan.toString()


def test_staged_rows_live_in_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = stage(spark.range(3), "three")
    assert df.inputFiles()[0].removeprefix("file://").startswith(shared_dir(spark))
    assert rows(df) == [(0,), (1,), (2,)]
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_window_ingest_loads_each_file_once(spark, write_json, tmp_path):
    for minute in range(3):
        write_json(f"legacy_ladders_raw_5_2026-03-07_000{minute}.json", sample.legacy())
    write_json("legacy_ladders_raw_6_2026-03-07_0000.json", sample.legacy([(None, "Nil", 1, 1), (5, "Eve", 1, 1)]))
    bronze, target = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def ingest(window=None, **kw):
        return rows(silver.ingest_window(spark, silver.LEGACY, bronze, target, "2026-03-08 00:00:00", window, **kw))

    assert ingest(1) == [(3, 3, 0, 2, True)]
    assert ingest(1) == [(0, 0, 0, 2, True)]
    assert ingest(files_at_once=1) == [(4, 4, 0, 0, False)]
    table = tables.read_table(spark, f"{target}/legacy_ladder_members", schemas.LEGACY_LADDER_MEMBERS)
    assert table.count() == 7 and table.select(*table.columns[:-1]).distinct().count() == 7
    assert {r.loaded_at for r in table.collect()} == {datetime(2026, 3, 8)}
    ledger = tables.read_table(spark, f"{target}/processed_files", schemas.PROCESSED_FILES)
    assert ledger.count() == 4
    # A run that died before noting the files loads them again, without any effect.
    shutil.rmtree(f"{target}/processed_files")
    assert ingest() == [(7, 0, 7, 0, False)]


def test_all_flows_share_the_ledger(spark, write_json, tmp_path):
    write_json("league_raw_5_2026-03-07_0000.json", sample.league())
    write_json("modern_ladders_raw_5_2026-03-07_0000.json", sample.modern())
    write_json("legacy_ladders_raw_5_2026-03-07_0000.json", sample.legacy())
    write_json("matches_all_history_2026-03-07_0000.json", sample.matches())
    bronze, target = str(tmp_path / "bronze"), str(tmp_path / "silver")
    got = {k: rows(v)[0] for k, v in silver.ingest_all(spark, bronze, target, "2026-03-08 00:00:00").items()}
    assert got == {
        "league_divisions": (4, 4, 0, 0, False),
        "modern_ladder_teams": (2, 2, 0, 0, False),
        "legacy_ladder_members": (2, 2, 0, 0, False),
        "match_history": (4, 4, 0, 0, False),
    }


def test_broken_rows_are_set_aside(spark, write_json, tmp_path):
    document = sample.league()
    document["tier"][0]["division"][0]["member_count"] = 70000
    del document["tier"][1]["division"][0]["ladder_id"]
    docs = documents.read_documents(
        spark, write_json("league_raw_5_2026-03-07_0000.json", document), silver.LEAGUE.document
    )
    sound, broken = silver.prepare(silver.LEAGUE, docs)
    assert rows(sound, "ladder_id") == [(5533,), (5547,)]
    assert rows(broken, "violation") == [("ladder_id: null",), ("member_count: out of range",)]
    target = str(tmp_path / "silver")
    assert silver.load(silver.LEAGUE, docs, target, "2026-03-08 00:00:00") == (2, 2)
    aside = tables.read_table(spark, f"{target}/quarantine", schemas.QUARANTINE)
    assert rows(aside, "source", "violation") == [
        ("league_divisions", "ladder_id: null"), ("league_divisions", "member_count: out of range"),
    ]
    assert any('"member_count":70000' in r.content for r in aside.collect())


def test_landed_documents_read_back(spark, tmp_path):
    root = str(tmp_path / "landed")
    df = spark.createDataFrame(
        [(5, datetime(2026, 3, 7, 4, 40), '{"key": {"league_id": 5}, "tier": []}')],
        "league INT, taken TIMESTAMP_NTZ, payload STRING",
    )
    documents.land(df, root, "league_raw", "payload", "taken", "league")
    got = documents.read_landed(spark, root, "league_raw", silver.LEAGUE.document)
    assert rows(got, "file_name") == [("league_raw_5_2026-03-07_0440.json",)]
    assert got.first()["key"]["league_id"] == "5"


def test_all_pending_files_are_loaded(spark, write_json, tmp_path):
    for minute in range(12):
        write_json(f"legacy_ladders_raw_5_2026-03-07_00{minute:02d}.json", sample.legacy([(minute + 1, "Ann", 3, 1)]))
    bronze, target = str(tmp_path / "bronze"), str(tmp_path / "silver")
    assert rows(silver.ingest_window(spark, silver.LEGACY, bronze, target, "2026-03-08 00:00:00")) == [(12, 12, 0, 0, False)]


def test_staged_tables_go_when_the_job_ends(spark):
    with staging(spark):
        path = stage(spark.range(3), "gone").inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert os.path.isdir(path)
    assert not os.path.exists(path)


def test_old_versions_go(spark, tmp_path):
    root = str(tmp_path / "state")
    for n in range(5):
        tables.write_version(spark.createDataFrame([(1, n, datetime(2026, 1, 1))], STATE.schema), root)
    assert tables.versions(spark, root) == [3, 4, 5]
    assert rows(tables.read_version(spark, root, STATE, below=5), "total_games") == [(3,)]


DAYS = schemas.Table("days", "k INT, t TIMESTAMP_NTZ, v STRING", ("k",), ("k",), time="t")


def _days(spark, value, *numbers):
    return spark.createDataFrame([(n, datetime(2026, 1, n), value) for n in numbers], DAYS.schema)


def _held(spark, path):
    return rows(tables.read_table(spark, path, DAYS), "k", "v")


def _stop_after(monkeypatch, moves):
    """The writer dies after so many of its moves, in the middle of the next."""
    plain, left = tables._move_day, [moves]

    def move(spark, source, target):
        if not left[0]:
            fs, old = tables._folder(spark, target)
            fs.delete(old, True)
            raise RuntimeError("died")
        left[0] -= 1
        plain(spark, source, target)

    monkeypatch.setattr(tables, "_move_day", move)
    return lambda: monkeypatch.setattr(tables, "_move_day", plain)


@pytest.mark.parametrize("moves", [0, 1, 2])
@pytest.mark.parametrize("then", ["read", "replace", "append"])
def test_a_writer_that_dies_between_two_moves_loses_no_day(spark, tmp_path, monkeypatch, moves, then):
    path = str(tmp_path / "table")
    tables.append(_days(spark, "old", 1, 2, 3, 4), path, DAYS)
    heal = _stop_after(monkeypatch, moves)
    with pytest.raises(RuntimeError, match="died"):
        tables.replace_days(_days(spark, "new", 1, 2, 3, 5), path, DAYS)
    heal()
    new = [(1, "new"), (2, "new"), (3, "new"), (4, "old"), (5, "new")]
    assert _held(spark, path) == new
    assert rows(tables.read_table(spark, path, DAYS, days=[date(2026, 1, 2), date(2026, 1, 4)]), "k", "v") == [(2, "new"), (4, "old")]
    if then == "replace":  # computed from what waits
        later = tables.read_table(spark, path, DAYS, days=[date(2026, 1, 1)]).withColumn("v", F.concat("v", F.lit("er")))
        tables.replace_days(later, path, DAYS)
        new[0] = (1, "newer")
    if then == "append":
        tables.append(_days(spark, "more", 2), path, DAYS)
        new.append((2, "more"))
    assert _held(spark, path) == sorted(new, key=repr)
    if then != "read":
        assert tables._waiting(spark, path) == []


def test_new_days_that_were_never_complete_count_for_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.append(_days(spark, "old", 1, 2), path, DAYS)
    part = tmp_path / "table" / "_replacing" / "000001-x" / "day=2026-01-01"
    part.mkdir(parents=True)
    assert _held(spark, path) == [(1, "old"), (2, "old")]
    tables.replace_days(_days(spark, "new", 2), path, DAYS)
    assert _held(spark, path) == [(1, "old"), (2, "new")]
    assert not part.exists()
