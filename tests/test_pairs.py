import random
from datetime import date, datetime, timedelta

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from rungworks.operators import inference, pairs
from rungworks.plans import gold

AT = datetime(2026, 1, 10, 12)
TODAY, OLD = date(2026, 1, 10), date(2026, 1, 1)
AS_OF = "2026-01-10 18:00:00"
REPORT = "profile_id INT, match_date TIMESTAMP_NTZ, map STRING, type STRING, decision STRING, snapshot_date DATE"


def games(spark, reports, **kw):
    return gold.rebuilt_games(spark.createDataFrame(reports, REPORT), AS_OF, **kw)


def ids(df):
    return rows(df, "p1_id", "p2_id", "map", "p1_decision", "p2_decision")


def report(player, decision, map_="Dusk", at=AT, seen=TODAY, kind="1v1"):
    return player, at, map_, kind, decision, seen


def expected(reports):
    """The pairing rule spelled out: {(p1, p2, time, map)} with p2 empty for the unmatched."""
    recent = [r for r in reports if r[5] >= date(2026, 1, 7)]
    found = {
        (a[0], b[0], a[1], a[2])
        for a in recent
        for b in reports
        if a[1] == b[1] and a[2] == b[2] and a[2] is not None and a[3] == b[3]
        and a[0] < b[0] and None not in (a[4], b[4]) and a[4] != b[4]
    }
    inside = {(p, t, m) for p1, p2, t, m in found for p in (p1, p2)}
    return found | {(r[0], None, r[1], r[2]) for r in recent if (r[0], r[1], r[2]) not in inside}


def test_pair_found(spark):
    assert ids(games(spark, [report(2, "LOSS"), report(1, "WIN")])) == [(1, 2, "Dusk", "WIN", "LOSS")]


@pytest.mark.parametrize(
    "other",
    [
        report(2, "WIN"),
        report(2, None),
        report(2, "LOSS", map_="Dawn"),
        report(2, "LOSS", at=AT + timedelta(seconds=1)),
        report(2, "LOSS", kind="2v2"),
    ],
    ids=["same decision", "no decision", "map", "time", "type"],
)
def test_no_pair(spark, other):
    alone = games(spark, [report(1, "WIN"), other]).where("p1_id = 1")
    assert ids(alone) == [(1, None, "Dusk", "WIN", None)]


def test_only_the_lower_id_must_be_in_the_window(spark):
    old = report(2, "LOSS", seen=OLD)
    assert ids(games(spark, [report(1, "WIN"), old])) == [(1, 2, "Dusk", "WIN", "LOSS")]
    assert ids(games(spark, [report(1, "LOSS", seen=OLD), report(2, "WIN")])) == [(2, None, "Dusk", "WIN", None)]


def test_window_counts_days_from_the_runs_day(spark):
    edge = [report(1, "WIN", seen=date(2026, 1, 7)), report(5, "WIN", map_="Dawn", seen=date(2026, 1, 6))]
    assert ids(games(spark, edge)) == [(1, None, "Dusk", "WIN", None)]


def test_three_players_at_one_time_and_map(spark):
    got = games(spark, [report(1, "WIN"), report(2, "LOSS"), report(3, "LOSS")])
    assert ids(got) == [(1, 2, "Dusk", "WIN", "LOSS"), (1, 3, "Dusk", "WIN", "LOSS")]


def test_reports_without_map_stand_alone_and_are_quarantined(spark):
    reports = [report(1, "WIN", map_=None), report(2, "LOSS", map_=None), report(3, "WIN", map_="? 1"), report(1, "LOSS", map_="? 1")]
    assert ids(games(spark, reports)) == [
        (1, 3, "? 1", "LOSS", "WIN"), (1, None, None, "WIN", None), (2, None, None, "LOSS", None),
    ]
    assert pairs.without_map(spark.createDataFrame(reports, REPORT)).count() == 2


def test_reading_only_since_the_earliest_match_changes_nothing(spark):
    old_game = AT - timedelta(days=30)
    reports = [
        report(1, "WIN", at=AT - timedelta(days=2)), report(2, "LOSS", at=AT - timedelta(days=2), seen=OLD),
        report(1, "WIN", at=old_game, seen=OLD), report(2, "LOSS", at=old_game, seen=OLD), report(3, "WIN"),
    ]
    history = spark.createDataFrame(reports, REPORT)
    since = gold.earliest_match(history, AS_OF)
    assert since == AT - timedelta(days=2)
    assert rows(games(spark, reports, history_since=since)) == rows(games(spark, reports))
    assert gold.earliest_match(history.where("false"), AS_OF) is None


def test_several_reports_of_one_player(spark):
    reports = [report(1, "WIN"), report(1, "LOSS"), report(1, "WIN"), report(2, "WIN")]
    assert ids(games(spark, reports)) == [(1, 2, "Dusk", "LOSS", "WIN")]


@pytest.mark.parametrize("seed", range(3))
def test_against_the_rule_on_random_reports(spark, seed):
    rng = random.Random(seed)
    reports = [
        (
            rng.randrange(12),
            AT + timedelta(minutes=rng.randrange(6)),
            rng.choice(["Dusk", "Dawn", None]),
            "1v1",
            rng.choice(["WIN", "LOSS", "TIE", None]),
            rng.choice([TODAY, OLD]),
        )
        for _ in range(160)
    ]
    got = games(spark, reports)
    assert {tuple(r) for r in got.select("p1_id", "p2_id", "match_date", "map").collect()} == expected(reports)
    assert got.count() == len(expected(reports))
    seen = {(r[0], r[1], r[2], r[4]) for r in reports}
    for r in pairs.matched(got).collect():
        assert r.p1_decision != r.p2_decision
        assert (r.p1_id, r.match_date, r.map, r.p1_decision) in seen
        assert (r.p2_id, r.match_date, r.map, r.p2_decision) in seen
    assert pairs.participants(got).count() == pairs.matched(got).count() * 2 + pairs.unmatched(got).count()


def test_every_crowded_game_is_cut_and_gives_the_same_rows(spark):
    rng = random.Random(5)
    crowd = [report(rng.randrange(40), rng.choice(["WIN", "LOSS"]), map_=f"Arena{g}") for g in range(100) for _ in range(9)]
    rest = [report(rng.randrange(200), rng.choice(["WIN", "LOSS"]), map_=f"M{rng.randrange(60)}") for _ in range(240)]
    got = games(spark, crowd + rest, crowded=8, pairs_per_part=20)
    assert {tuple(r) for r in got.select("p1_id", "p2_id", "match_date", "map").collect()} == expected(crowd + rest)
    assert rows(got) == rows(games(spark, crowd + rest))


def test_a_crowded_game_is_never_shuffled_by_game_alone(spark):
    crowd = [report(i, "WIN" if i % 2 else "LOSS", map_="Arena") for i in range(60)]
    got = games(spark, [*crowd, report(1, "WIN")], crowded=50, pairs_per_part=400)
    assert got.count() == 901
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [game") == 2  # both sides of the plain way; none of the other


def test_both_sides_read_one_shuffle(spark):
    history = spark.createDataFrame([report(1, "WIN"), report(2, "LOSS")], REPORT)
    players = pairs.player_games(pairs.game_reports(history, F.lit(True)).repartition(*pairs.SAME_GAME))
    got = pairs._paired(players, players, list(pairs.SAME_GAME))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == plan.count("ReusedExchange") + 1 == 2


def test_large_window_tables_are_joined_as_usual(spark):
    reports = [report(1, "WIN"), report(2, "LOSS"), report(9, "WIN", map_="Old", seen=OLD)]
    few = rows(games(spark, reports))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(games(spark, reports)) == few
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ------------------------------------------------------------------- inference

TRACK = "character_id INT, race STRING, snapshot_ts TIMESTAMP_NTZ, rating INT"


def track(spark, *values):
    return spark.createDataFrame([(c, r, t, n) for c, r, t, n in values], TRACK)


def known(spark, *values):
    return spark.createDataFrame(list(values), "character_id INT, race STRING")


def inferred(spark, reports, track_rows, dim_rows, **kw):
    facts = gold.match_facts(
        spark.createDataFrame(reports, REPORT), track(spark, *track_rows), known(spark, *dim_rows), AS_OF, **kw
    )
    return {
        r.p1_character_id: (r.p1_race_inferred, r.p1_race_confidence, r.p2_race_inferred, r.p2_race_confidence)
        for r in facts.collect()
    }


PAIR = [report(1, "WIN"), report(2, "LOSS")]


def test_closest_ratings_win_against_an_opponent(spark):
    ratings = [
        (1, "Zerg", AT, 4000), (1, "Terran", AT, 3000), (2, "Zerg", AT, 3100), (2, "Protoss", AT, 5000),
        (1, "Zerg", AT - timedelta(days=1), 3100),
    ]
    races = [(1, "Zerg"), (1, "Terran"), (2, "Protoss")]
    assert inferred(spark, PAIR, ratings, races) == {1: ("Terran", "LOW", "Zerg", "HIGH")}


def test_highest_rating_wins_alone(spark):
    ratings = [(1, "Zerg", AT, 4000), (1, "Terran", AT, 4500), (1, "Random", AT, None)]
    assert inferred(spark, PAIR[:1], ratings, [(1, "Zerg")]) == {1: ("Terran", "HIGH", None, None)}


def test_equal_costs_are_settled_by_name(spark):
    ratings = [(1, "Zerg", AT, 4000), (1, "Protoss", AT, 4000), (2, "Zerg", AT, 4100), (2, "Terran", AT, 3900)]
    assert inferred(spark, PAIR, ratings, []) == {1: ("Protoss", "LOW", "Terran", "LOW")}


def test_unrated_players_count_as_zero_and_keep_no_race(spark):
    ratings = [(1, "Zerg", AT, 4000), (1, "Terran", AT, 100)]
    assert inferred(spark, PAIR, ratings, [(2, "Zerg")]) == {1: ("Terran", "LOW", None, "HIGH")}
    assert inferred(spark, PAIR, [], []) == {1: (None, "LOW", None, "LOW")}


def test_outside_evidence_boosts_low_games_only(spark):
    evidence = spark.createDataFrame(
        [
            (1, AT - timedelta(minutes=30), "Random"),
            (1, AT - timedelta(minutes=60), "Zerg"),
            (2, AT - timedelta(minutes=30), "Random"),
            (3, AT - timedelta(minutes=90), "Terran"),
            (4, AT - timedelta(minutes=91), "Terran"),
        ],
        "character_id INT, match_date TIMESTAMP_NTZ, race STRING",
    )
    reports = [*PAIR, report(3, "WIN", map_="Dawn"), report(4, "WIN", map_="Noon")]
    got = inferred(spark, reports, [(2, "Zerg", AT, 1)], [(2, "Zerg")], evidence=evidence)
    assert got == {
        1: ("Random", "BOOSTED", "Zerg", "HIGH"),
        3: ("Terran", "BOOSTED", None, None),
        4: (None, "LOW", None, None),
    }


def test_only_evidence_within_reach_of_a_game_is_moved(spark):
    minutes = (-91, -90, -1, 0, 59, 60, 61)
    ddl = "character_id INT, match_date TIMESTAMP_NTZ, race STRING"
    evidence = spark.createDataFrame([(1, AT + timedelta(minutes=m), str(m)) for m in minutes], ddl)
    played = spark.createDataFrame([(AT,), (AT + timedelta(minutes=60),)], "match_date TIMESTAMP_NTZ")
    reach = inference._within_reach(evidence, played, inference.SESSION)
    assert rows(reach, "race") == [("-1",), ("-90",), ("0",), ("59",)]
    assert rows(inference._within_reach(evidence, played.where("false"), inference.SESSION)) == []


def test_evidence_from_the_same_games_boosts_nothing(spark):
    reports = [report(p, d, at=AT + timedelta(minutes=m)) for m in (0, 20, 40) for p, d in ((1, "WIN"), (2, "LOSS"))]
    ratings = [(1, "Zerg", AT, 10), (2, "Zerg", AT, 10), (2, "Terran", AT, 12)]
    races = [(1, "Zerg"), (2, "Zerg"), (2, "Terran")]
    games_ = gold.rebuilt_games(spark.createDataFrame(reports, REPORT), AS_OF)
    plain = gold.inferred_games(games_, track(spark, *ratings), known(spark, *races))
    evidence = inference.high_confidence_evidence(plain)
    assert evidence.count() == 3
    boosted = gold.inferred_games(games_, track(spark, *ratings), known(spark, *races), evidence)
    assert rows(plain, "p1_id", "p1_race", "p1_confidence", "p2_race", "p2_confidence") == rows(
        boosted, "p1_id", "p1_race", "p1_confidence", "p2_race", "p2_confidence"
    )


def test_match_keys_are_unique_and_never_null(spark):
    reports = [*PAIR, report(3, "WIN", map_="Dawn"), report(5, "WIN", map_=None)]
    facts = gold.match_facts(spark.createDataFrame(reports, REPORT), track(spark), known(spark), AS_OF)
    keys = [r.match_id for r in facts.collect()]
    assert len(keys) == len(set(keys)) == 2 and all(len(k) == 32 for k in keys)
    one = facts.where(F.col("p1_character_id") == 1).first().match_id
    assert one == spark.sql("SELECT md5('122026-01-10 12:00:00Dusk')").first()[0]
