"""One key holding a third of all rows: results against plain Python."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from rungworks.operators import changes, daily, inference
from rungworks.operators.latest import first_n_per_key, latest_per_key
from rungworks.sources import listing

START = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def snapshots(spark):
    rng = random.Random(3)
    values = [
        (
            0 if i % 3 == 0 else rng.randrange(1, 300),
            rng.choice(["Zerg", "Terran", "Protoss"]),
            START + timedelta(minutes=rng.randrange(60 * 24 * 4)),
            rng.randrange(5000),
        )
        for i in range(9000)
    ]
    df = spark.createDataFrame(values, "character_id INT, race STRING, snapshot_ts TIMESTAMP_NTZ, rating INT")
    return values, df.repartition(8).cache()


def test_latest_ratings(snapshots):
    values, df = snapshots
    want = {}
    for c, race, ts, rating in values:
        want[c, race] = max(want.get((c, race), (ts, rating)), (ts, rating))
    assert rows(inference.latest_ratings(df)) == sorted(((c, r, n) for (c, r), (_, n) in want.items()), key=repr)


def test_first_rows(snapshots):
    values, df = snapshots
    by_key = defaultdict(list)
    for v in values:
        by_key[v[0]].append(v)
    newest = first_n_per_key(df, ["character_id"], [F.col(c).desc() for c in df.columns[::-1]], 3)
    want = [v for group in by_key.values() for v in sorted(group, key=lambda v: v[::-1], reverse=True)[:3]]
    assert rows(newest) == sorted(want, key=repr)
    assert latest_per_key(df, ["character_id"], "snapshot_ts").count() == len(by_key)


def test_race_counts_and_profiles(snapshots):
    values, df = snapshots
    races = defaultdict(set)
    for c, race, *_ in values:
        races[c].add(race)
    assert rows(inference.race_counts(df)) == sorted(((c, len(r)) for c, r in races.items()), key=repr)
    profiles = inference.race_profiles(df, df).collect()
    assert {p.character_id: {r.race for r in p.ratings} for p in profiles} == races


def test_counters_and_daily_tables(snapshots):
    values, df = snapshots
    most = defaultdict(int)
    days = defaultdict(list)
    for c, race, ts, rating in values:
        most[c] = max(most[c], rating)
        days[c, ts.date()].append((ts, rating, race))
    counters = changes.max_counter_first_seen(df, "character_id", F.col("rating"), ["race"], ["snapshot_ts", "race"])
    assert rows(counters, "character_id", "current_games") == sorted(most.items(), key=repr)
    ratings = daily.player_mmr_daily(
        df.withColumnRenamed("character_id", "profile_id").withColumnRenamed("race", "battle_tag")
    )
    assert rows(ratings) == sorted(
        ((c, d, max(r for _, r, _ in seen), max(seen)[1], max(seen)[2]) for (c, d), seen in days.items()), key=repr
    )
    assert daily.mmr_checkpoints(
        df.withColumnRenamed("character_id", "profile_id").withColumn("ladder_id", F.lit(1))
    ).count() == len({(v[0], v[2]) for v in values})


def test_listing_of_one_crowded_league(spark):
    names = [(f"league_raw_5_{START + timedelta(minutes=i):%Y-%m-%d_%H%M}.json",) for i in range(3000)]
    names += [(f"league_raw_{6 + i % 50}_{START + timedelta(minutes=i):%Y-%m-%d_%H%M}.json",) for i in range(3000)]
    files = listing.describe(spark.createDataFrame(names, "file_name STRING").repartition(8))
    assert listing.last_files(files, 10).count() == 51 * 10
    newest = {r.file_name for r in listing.latest_file(files).where("league_id = 5").collect()}
    assert newest == {names[2999][0]}
