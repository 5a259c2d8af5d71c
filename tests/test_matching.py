"""One game per report, against all ways to pair them."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rungworks.operators import matching, pairs

AT = datetime(2026, 1, 10, 12)
REPORT = "profile_id BIGINT, match_date TIMESTAMP_NTZ, map STRING, type STRING, decision STRING"


def _assigned(spark, reports, ratings, **kw):
    history = spark.createDataFrame([(p, AT, m, "1v1", d) for p, m, d in reports], REPORT)
    known = spark.createDataFrame(list(ratings.items()), "profile_id BIGINT, rating INT")
    found = matching.assigned(matching.rated_players(pairs.game_reports(history, F.lit(True)), known), **kw)
    return sorted(((r.map, r.p1_id, r.p2_id, r.cost) for r in found.collect()), key=repr)


def _ways(ids):
    if not ids:
        yield ()
        return
    first, rest = ids[0], ids[1:]
    yield from _ways(rest)
    for other in rest:
        for way in _ways([i for i in rest if i != other]):
            yield ((first, other), *way)


def _brute(reports, ratings):
    found = []
    for map_ in {m for _, m, d in reports if m}:
        told = {}
        for p, m, d in reports:
            if m == map_ and d is not None and p is not None:
                told.setdefault(p, set()).add(d)
        able = lambda a, b: min(told[a]) != max(told[b]) or max(told[a]) != min(told[b])  # noqa: E731, B023
        cost = lambda a, b: abs(ratings.get(a, 0) - ratings.get(b, 0))
        ways = [w for w in _ways(sorted(told)) if all(able(a, b) for a, b in w)]
        best = min(ways, key=lambda w: (-len(w), sum(cost(a, b) for a, b in w), sorted(w)))
        found += [(map_, a, b, cost(a, b)) for a, b in best]
        found += [(map_, a, None, None) for a in told if a not in {i for pair in best for i in pair}]
    return sorted(found, key=repr)


def test_two_games_at_once_give_two_pairs(spark):
    reports = [(1, "Dusk", "WIN"), (2, "Dusk", "LOSS"), (3, "Dusk", "WIN"), (4, "Dusk", "LOSS")]
    assert _assigned(spark, reports, {1: 4000, 4: 3990, 2: 1000, 3: 1010}) == [("Dusk", 1, 4, 10), ("Dusk", 2, 3, 10)]


def test_equal_to_all_ways_for_groups_up_to_eight(spark):
    rng = random.Random(11)
    reports, ratings = [], {p: rng.randrange(5000) for p in range(0, 400, 2)}
    for group in range(60):
        for _ in range(rng.randrange(1, 11)):
            if len({p for p, m, _ in reports if m == f"m{group}"}) < 8:
                reports.append((rng.randrange(400), f"m{group}", rng.choice(["WIN", "LOSS", "WIN", "LOSS", "TIE", None])))
    reports += [(1, None, "WIN"), (2, None, "LOSS"), (None, "m0", "WIN")]
    assert _assigned(spark, reports, ratings) == _brute(reports, ratings)


@pytest.mark.parametrize("decisions", ["WL", "WLT", "WWWWL", "W"])
def test_crowded_groups_lose_no_report_and_no_pair(spark, decisions):
    rng = random.Random(decisions)
    reports = [(p, "Dusk", rng.choice(decisions)) for p in range(700)] + [(9000, "Dawn", "W"), (9001, "Dawn", "L")]
    ratings = {p: rng.randrange(300) for p in range(700)}
    found = [r for r in _assigned(spark, reports, ratings) if r[0] == "Dusk"]
    told = dict((p, d) for p, _, d in reports)
    assert sorted(p for _, a, b, _ in found for p in (a, b) if p is not None) == list(range(700))
    assert all(a < b and told[a] != told[b] and cost == abs(ratings[a] - ratings[b]) for _, a, b, cost in found if b is not None)
    most = max(sum(told[p] == d for p in range(700)) for d in decisions)
    assert sum(b is not None for *_, b, _ in found) == min(350, 700 - most)


def test_two_decisions_that_share_a_crowded_group_equally_cost_least(spark):
    rng = random.Random(1)
    reports = [(p, "Dusk", "WL"[p % 2]) for p in range(300)]
    ratings = {p: rng.randrange(10_000) for p in range(300)}
    found = _assigned(spark, reports, ratings)
    wins, losses = (sorted(ratings[p] for p in range(300) if p % 2 == k) for k in (0, 1))
    assert sum(cost for *_, cost in found) == sum(abs(a - b) for a, b in zip(wins, losses, strict=True))
