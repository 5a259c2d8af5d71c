from datetime import datetime, timedelta

from tests.helpers import rows

import documents as sample
from rungworks import schemas
from rungworks.operators.merge import INCOMING
from rungworks.plans import silver, worklists
from rungworks.sources import tables
from rungworks.streaming import ingest as streams

AS_OF = "2026-03-08 00:00:00"


def test_each_file_is_worked_off_once_and_replays_change_nothing(spark, write_json, tmp_path):
    target = str(tmp_path / "silver")
    source = str(tmp_path / "bronze")
    flow = silver.MATCHES

    def run(progress):
        stream = streams.document_stream(spark, source, flow.document, f"{flow.kind}_*.json", max_files=1)
        query = streams.ingest(stream, flow, target, str(tmp_path / progress), AS_OF)
        query.awaitTermination()
        return sum(p.numInputRows for p in query.recentProgress)

    write_json("matches_all_history_2026-03-07_0000.json", sample.matches())
    write_json("matches_all_history_2026-03-07_0100.json", [])
    write_json("notes_2026-03-07_0100.json", [{"matches": [{"date": 1}]}])
    assert run("p") == 3
    assert run("p") == 0
    write_json("matches_all_history_2026-03-07_0200.json", sample.matches())
    assert run("p") == 3
    table = tables.read_table(spark, f"{target}/match_history", flow.table)
    once = rows(table)
    assert len(once) == 4
    # The same files under a lost checkpoint.
    assert run("q") == 6
    assert rows(tables.read_table(spark, f"{target}/match_history", flow.table)) == once


def test_changes_are_handled_before_the_state_advances(spark, write_json, tmp_path):
    source, state = str(tmp_path / "bronze"), str(tmp_path / "state")
    flow = silver.LEGACY
    handled = []

    def run(handle):
        stream = streams.document_stream(spark, source, flow.document, f"{flow.kind}_*.json", max_files=1)
        streams.detect_changes(
            stream,
            worklists.newest_counters,
            state,
            handle,
            str(tmp_path / "p"),
            AS_OF,
        ).awaitTermination()

    def collect(changed, _):
        handled.append(rows(changed, "character_id", "current_games"))

    def fail(changed, _):
        raise RuntimeError("fetch failed")

    write_json("legacy_ladders_raw_5_2026-03-07_0000.json", sample.legacy([(1, "Ann", 3, 1), (2, "Bob", 0, 0)]))
    try:
        run(fail)
    except Exception as error:
        assert "fetch failed" in str(error)
    assert tables.read_version(spark, state, schemas.MATCH_HISTORY_CHECKPOINT).isEmpty()
    run(collect)
    write_json("legacy_ladders_raw_5_2026-03-07_0010.json", sample.legacy([(1, "Ann", 3, 1), (2, "Bob", 1, 0)]))
    run(collect)
    assert handled == [[(1, 4)], [(2, 1)]]
    got = tables.read_version(spark, state, schemas.MATCH_HISTORY_CHECKPOINT)
    assert rows(got, "character_id", "total_games") == [(1, 4), (2, 1)]


def test_a_rerun_corrects_earlier_rows(spark, tmp_path):
    root, source = str(tmp_path / "facts"), str(tmp_path / "in")
    table = schemas.Table("t", "k INT, fixed STRING, race STRING", ("k",), ("k",))

    def run(*values):
        spark.createDataFrame(list(values), table.columns).write.mode("append").parquet(source)
        stream = spark.readStream.schema(table.schema).parquet(source)
        streams.upsert_batches(stream, table, root, {"race": INCOMING}, str(tmp_path / "p")).awaitTermination()
        return rows(tables.read_version(spark, root, table))

    assert run((1, "a", "Zerg"), (2, "b", "Zerg")) == [(1, "a", "Zerg"), (2, "b", "Zerg")]
    assert run((2, "changed", "Terran"), (3, "c", None)) == [(1, "a", "Zerg"), (2, "b", "Terran"), (3, "c", None)]


def test_first_sightings_and_lookups_of_a_stream(spark, tmp_path):
    at = datetime(2026, 1, 1)
    ddl = "k INT, t TIMESTAMP_NTZ"
    source, out, found = str(tmp_path / "in"), str(tmp_path / "out"), []
    values = [(1, at), (1, at), (2, at + timedelta(hours=1)), (1, at + timedelta(hours=1))]
    spark.createDataFrame(values, ddl).write.parquet(source)
    spark.createDataFrame([(9, at - timedelta(days=400)), values[0]], ddl).write.mode("append").parquet(source)
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(source)
    table = schemas.Table("seen", ddl, ("k", "t"), ("k", "t"), time="t")
    for progress in ("p1", "p3"):  # the second time under a lost checkpoint
        streams.first_sightings(stream, table, out, str(tmp_path / progress)).awaitTermination()
        assert rows(tables.read_table(spark, out, table)) == sorted({*values, (9, at - timedelta(days=400))}, key=repr)

    evidence = spark.createDataFrame([(1, at + timedelta(minutes=5), "Zerg")], "k INT, s TIMESTAMP_NTZ, v STRING")
    streams.lookup_batches(
        spark.readStream.schema(ddl).parquet(source), lambda _: evidence, lambda b, _: found.extend(rows(b, "k", "t", "v")), str(tmp_path / "p2"),
        key="k", probe_ts="t", evidence_ts="s", value="v", tolerance=timedelta(minutes=90),
    ).awaitTermination()
    assert found == [(1, at + timedelta(hours=1), "Zerg")]


def test_a_batch_repeated_after_the_state_write_hands_over_the_same_changes(spark, write_json, tmp_path, monkeypatch):
    source, state = str(tmp_path / "bronze"), str(tmp_path / "state")
    flow, handled = silver.LEGACY, []
    write_json("legacy_ladders_raw_5_2026-03-07_0000.json", sample.legacy([(1, "Ann", 6, 4)]))
    write_json("legacy_ladders_raw_5_2026-03-07_0010.json", sample.legacy([(1, "Ann", 3, 1)]))

    def run():
        stream = streams.document_stream(spark, source, flow.document, f"{flow.kind}_*.json")
        handle = lambda changed, n: handled.append((n, rows(changed, "character_id", "current_games")))
        streams.detect_changes(stream, worklists.newest_counters, state, handle, str(tmp_path / "p"), AS_OF).awaitTermination()

    write = tables.write_version

    def written_but_not_committed(*args, **kw):
        write(*args, **kw)
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "write_version", written_but_not_committed)
    try:
        run()
    except Exception as error:
        assert "lost" in str(error)
    monkeypatch.setattr(tables, "write_version", write)
    run()
    # Of two snapshots in a batch the newest counts, though its counter fell.
    assert handled == [(0, [(1, 4)]), (0, [(1, 4)])]
    write_json("legacy_ladders_raw_5_2026-03-07_0020.json", sample.legacy([(1, "Ann", 2, 1)]))
    run()
    assert handled[2:] == [(1, [(1, 3)])]
    assert rows(tables.read_version(spark, state, schemas.MATCH_HISTORY_CHECKPOINT), "total_games") == [(3,)]


def test_replays_do_not_double_the_quarantine(spark, write_json, tmp_path):
    document = sample.league()
    document["tier"][0]["division"][0]["member_count"] = 70000
    path = write_json("league_raw_5_2026-03-07_0000.json", document)
    docs = documents_of(spark, path)
    target = str(tmp_path / "silver")
    for _ in range(2):
        silver.load(silver.LEAGUE, docs, target, AS_OF)
    assert tables.read_table(spark, f"{target}/quarantine", schemas.QUARANTINE).count() == 1


def documents_of(spark, path):
    from rungworks.sources.documents import read_documents

    return read_documents(spark, path, silver.LEAGUE.document)


def test_upserts_by_day_touch_only_the_days_of_the_batch(spark, tmp_path):
    root, source = str(tmp_path / "facts"), str(tmp_path / "in")
    table = schemas.Table("t", "k INT, t TIMESTAMP_NTZ, race STRING", ("k",), ("k",), time="t")
    one, two = datetime(2026, 1, 1), datetime(2026, 1, 2)

    def run(*values):
        spark.createDataFrame(list(values), table.schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(table.schema).parquet(source)
        streams.upsert_batches(stream, table, root, {"race": INCOMING}, str(tmp_path / "p")).awaitTermination()
        return rows(tables.read_table(spark, root, table))

    assert run((1, one, "Zerg"), (2, two, "Zerg")) == [(1, one, "Zerg"), (2, two, "Zerg")]

    def files():
        return {f for f in tables.read_table(spark, root, table).inputFiles() if "day=2026-01-01" in f}

    before = files()
    assert run((2, two, "Terran"), (3, two, "Protoss")) == [(1, one, "Zerg"), (2, two, "Terran"), (3, two, "Protoss")]
    assert before == files()
