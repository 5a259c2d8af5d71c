import random
from datetime import datetime

from tests.helpers import rows
from pyspark.sql import functions as F

from rungworks import schemas
from rungworks.operators import merge
from rungworks.plans import gold

DIM = schemas.DIM_PLAYERS


def _kv(spark, *values):
    return spark.createDataFrame(list(values), "k INT, v STRING")


def test_insert_if_absent_never_changes_held_rows(spark):
    target = _kv(spark, (1, "a"), (2, "b"))
    batch = _kv(spark, (2, "z"), (3, "d"), (3, "c"), (None, "x"))
    assert rows(merge.insert_if_absent(target, batch, ["k"], ["k"])) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(merge.rows_to_insert(target, batch, ["k"], ["k"])) == [(3, "c")]
    fresh = merge.rows_to_insert(target, batch, ["k"], ["k"])
    assert rows(merge.load_summary(batch, fresh)) == [(4, 1, 3)]
    again = merge.rows_to_insert(target.unionByName(fresh), batch, ["k"], ["k"])
    assert again.isEmpty()
    nothing = batch.where("false")
    assert rows(merge.load_summary(nothing, merge.rows_to_insert(target, nothing, ["k"]))) == [(0, 0, 0)]


def test_first_row_of_a_key_follows_the_given_order(spark):
    batch = _kv(spark, (1, "a"), (1, "b"))
    assert rows(merge.unique_by_key(batch, ["k"], [F.col("v").desc()])) == [(1, "b")]
    assert rows(merge.unique_by_key(batch, ["k"])) == [(1, "a")]


def test_upsert_rules(spark):
    ddl = "k INT, a STRING, b STRING, c STRING, d STRING"
    target = spark.createDataFrame([(1, "a1", "b1", "c1", "d1"), (2, "a2", "b2", "c2", "d2")], ddl)
    source = spark.createDataFrame([(1, None, None, "C", "D"), (3, "A", None, "C", "D")], ddl)
    got = merge.upsert(
        target,
        source,
        ["k"],
        {
            "a": merge.INCOMING,
            "b": merge.INCOMING_OR_TARGET,
            "c": merge.TARGET,
            "d": lambda c: F.concat(merge.old(c), merge.new(c)),
        },
    )
    assert rows(got) == [(1, None, "b1", "c1", "d1D"), (2, "a2", "b2", "c2", "d2"), (3, "A", None, "C", "D")]


def test_upsert_takes_one_row_per_key_and_keeps_the_targets_types(spark):
    target = spark.createDataFrame([(1, 5)], "k INT, n INT")
    source = spark.createDataFrame([(1, 9), (1, 8), (2, 7)], "k BIGINT, n BIGINT")
    got = merge.upsert(target, source, ["k"], {"n": merge.INCOMING})
    assert got.schema == target.schema
    assert rows(got) == [(1, 8), (2, 7)]


def test_upsert_with_nothing_incoming_changes_nothing(spark):
    target = _kv(spark, (1, "a"))
    assert rows(merge.upsert(target, target.where("false"), ["k"], {"v": merge.INCOMING})) == [(1, "a")]


def test_a_key_holding_a_third_of_the_rows(spark):
    rng = random.Random(7)
    values = [(0 if rng.random() < 0.34 else rng.randrange(400), f"{rng.randrange(10**6):06d}") for _ in range(6000)]
    batch = _kv(spark, *values).repartition(6)
    target = _kv(spark, *[(k, "held") for k in range(0, 400, 3)])
    want = {k: "held" for k in range(0, 400, 3)}
    for k, v in values:
        if k % 3:
            want[k] = min(v, want.get(k, v))
    assert rows(merge.insert_if_absent(target, batch, ["k"])) == sorted(want.items(), key=repr)


def _current(spark, *values):
    return spark.createDataFrame(
        list(values), "character_id INT, race STRING, battle_tag STRING, display_name STRING, clan_tag STRING"
    )


def test_player_dimension_remembers_names_and_clans(spark):
    first = gold.merge_players(
        DIM.empty(spark),
        _current(
            spark,
            (1, "Zerg", "t1", "Ann", "HIVE"),
            (2, "Zerg", "t2", "Bob", "HIVE"),
            (3, "Zerg", "t3", "Cid", None),
            (4, "Zerg", "t4", None, "X"),
            (5, "Zerg", "t5", "Eve", "X"),
        ),
        "2026-01-01 10:00:00",
    )
    assert first.schema.names == DIM.schema.names
    assert all(r.legacy_names == [] and r.legacy_clans == [] for r in first.collect())
    second = gold.merge_players(
        first,
        _current(
            spark,
            (1, "Zerg", None, "Anna", "SWARM"),
            (2, "Zerg", "t2", "Bob", None),
            (3, "Zerg", "t3", None, "NEW"),
            (4, "Zerg", "t4", "Dan", "X"),
            (6, "Terran", "t6", "Fay", None),
        ),
        "2026-01-02 10:00:00",
    )
    third = gold.merge_players(
        second, _current(spark, (1, "Zerg", "t9", "Ann", "SWARM")), "2026-01-03 10:00:00"
    )
    got = {r.character_id: r for r in third.collect()}
    ann = got[1]
    assert (ann.battle_tag, ann.display_name, ann.clan_tag) == ("t9", "Ann", "SWARM")
    assert [tuple(x) for x in ann.legacy_names] == [("Ann", "2026-01-02"), ("Anna", "2026-01-03")]
    assert [tuple(x) for x in ann.legacy_clans] == [("HIVE", "2026-01-02")]
    assert ann.updated_at == datetime(2026, 1, 3, 10)
    assert (got[2].clan_tag, got[2].legacy_clans) == ("HIVE", [])  # a lost clan stays
    assert (got[3].display_name, got[3].legacy_names, got[3].clan_tag) == (None, [], "NEW")
    assert (got[4].display_name, got[4].legacy_names) == ("Dan", [])
    assert got[5].updated_at == datetime(2026, 1, 1, 10)
    assert (got[6].race, got[6].legacy_names) == ("Terran", [])


def test_current_players_prefer_legacy_names(spark):
    modern = spark.createDataFrame(
        [
            (1, "Zerg", "old", "m-ann", datetime(2026, 1, 1)),
            (1, "Zerg", "new", "m-ann", datetime(2026, 1, 2)),
            (1, "Terran", "alt", "m-ann", datetime(2026, 1, 1)),
            (2, "Zerg", "bob", "m-bob", datetime(2026, 1, 1)),
            (3, None, "x", "x", datetime(2026, 1, 1)),
            (None, "Zerg", "x", "x", datetime(2026, 1, 1)),
        ],
        "character_id INT, primary_race STRING, battle_tag STRING, character_name STRING, snapshot_ts TIMESTAMP_NTZ",
    )
    legacy = spark.createDataFrame(
        [(1, "Ann", "HIVE", datetime(2026, 1, 1)), (1, "Anna", None, datetime(2026, 1, 2)), (None, "x", "x", datetime(2026, 1, 1))],
        "character_id INT, display_name STRING, clan_tag STRING, snapshot_ts TIMESTAMP_NTZ",
    )
    assert rows(gold.current_players(modern, legacy)) == [
        (1, "Terran", "alt", "Anna", None), (1, "Zerg", "new", "Anna", None), (2, "Zerg", "bob", "m-bob", None),
    ]


def test_known_matches_only_get_new_inferences(spark):
    facts = schemas.FACT_MATCHES
    at, later = datetime(2026, 1, 1), datetime(2026, 1, 2)
    held = spark.createDataFrame(
        [("m1", at, "Dusk", "1v1", 1, "WIN", "Zerg", "LOW", 2, "LOSS", None, "LOW")], facts.schema
    )
    came = spark.createDataFrame(
        [
            ("m1", later, "Dawn", "2v2", 8, "X", "Terran", "HIGH", 9, "Y", "Zerg", "HIGH"),
            ("m2", later, "Dawn", "1v1", 3, "WIN", None, "LOW", None, None, None, None),
        ],
        facts.schema,
    )
    assert rows(gold.merge_matches(held, came)) == [
        ("m1", at, "Dusk", "1v1", 1, "WIN", "Terran", "HIGH", 2, "LOSS", "Zerg", "HIGH"),
        ("m2", later, "Dawn", "1v1", 3, "WIN", None, "LOW", None, None, None, None),
    ]


def test_rating_track_rolls_and_settles_collisions(spark):
    ddl = "character_id INT, primary_race STRING, snapshot_ts TIMESTAMP_NTZ, ladder_id INT, rating INT, wins INT, losses INT"
    modern = spark.createDataFrame(
        [
            (1, "Zerg", datetime(2026, 1, 10), 7, 100, 1, 1),
            (1, "Zerg", datetime(2026, 1, 10), 5, 200, 1, 1),
            (1, "Zerg", datetime(2026, 1, 7), 5, 90, 1, 1),
            (1, "Zerg", datetime(2026, 1, 6, 23, 59), 5, 80, 1, 1),
            (2, None, datetime(2026, 1, 10), 5, 80, 1, 1),
            (3, "Zerg", datetime(2026, 1, 9), 5, 70, 1, 1),
        ],
        ddl,
    )
    track = spark.createDataFrame([(3, "Zerg", datetime(2026, 1, 9), 1, 1, 1, 1)], schemas.FACT_MMR_TRACK.schema)
    got = gold.rating_track_rows(track, modern, "2026-01-10 00:00:00")
    assert rows(got, "character_id", "snapshot_ts", "ladder_id", "rating") == [
        (1, datetime(2026, 1, 10), 5, 200), (1, datetime(2026, 1, 7), 5, 90),
    ]
