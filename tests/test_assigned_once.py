"""The search for games: the input is put together once, and groups are searched many at a time."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tests.llm.conftest import DATA
from tests.test_matching import _assigned, _brute

from rungworks.catalog.queries import QUERIES
from rungworks.operators import matching, pairs


def test_reports_are_put_together_once(spark):
    assert not [f for f in QUERIES["q21_assigned_games"](spark, DATA).inputFiles() if "lineitem" in f]


def test_groups_that_span_batches_stay_whole(spark, monkeypatch):
    rng = random.Random(3)
    reports = [(p, f"m{g}", rng.choice(["WIN", "LOSS", "TIE"])) for g in range(40) for p in rng.sample(range(50), rng.randrange(1, 7))]
    ratings = {p: rng.randrange(20) for p in range(0, 50, 2)}
    monkeypatch.setattr(matching, "ROWS", 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert _assigned(spark, reports, ratings) == _brute(reports, ratings)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ratings_far_apart_are_searched_exactly():
    rating = [-(2**62), 2**62, 2**62 - 1, -(2**62) + 1]
    rows = pa.table({"lo": list("WLWL"), "hi": list("WLWL"), "rating": pa.array(rating, pa.int64())})
    first, second, cost = matching.best_pairs(rows, np.array([0]))
    assert list(zip(first.tolist(), second.tolist(), cost.tolist(), strict=True)) == [(0, 3, 1), (1, 2, 1)]


def test_a_player_rated_twice_counts_twice(spark):
    twice = spark.createDataFrame([(1, 10), (1, 10), (2, 30)], "profile_id BIGINT, rating INT")
    reports = spark.createDataFrame([(1, "W"), (2, "L")], "profile_id BIGINT, decision STRING").selectExpr(
        "profile_id", "TIMESTAMP_NTZ'2026-01-10 12:00:00' AS match_date", "'Dusk' AS map", "'1v1' AS type", "decision"
    )
    found = matching.assigned(matching.rated_players(pairs.game_reports(reports, F.lit(True)), twice))
    assert sorted(((r.p1_id, r.p2_id, r.cost) for r in found.collect()), key=repr) == [(1, 2, 20), (1, None, None)]
