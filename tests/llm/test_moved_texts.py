"""Texts are moved once for the mix, and not at all where they have no copies."""

import random

import pytest

from rungworks.llm import exact, mixing


@pytest.fixture
def no_broadcast_at_run_time(spark):
    """Sort-merge joins unless a table is known to be small before the query begins, as on large tables."""
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield
    spark.conf.unset(key)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_mix_moves_texts_once(spark, no_broadcast_at_run_time):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(90))), rng.choice(["a", "b", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    mixed = mixing.mix(df)
    by_source = [line for line in _plan(mixed).splitlines() if "hashpartitioning(coalesce(_source" in line]
    assert not by_source
    assert {r.doc_id: r.size for r in mixed.collect()} == {i: len(t.split()) for i, t, _ in rows}


ROWS = [(i, f"t {i}", i) for i in range(400)] + [(1000 + i, f"t  {i % 7}", 1000 + i) for i in range(70)] + [(None, "t\t3", 2000), (5, "t\n5", 2001)]


@pytest.mark.parametrize("words", [1, 64, exact.WORDS], ids=["full", "some", "wide"])
def test_rows_without_copies_stay_where_they_are(spark, monkeypatch, no_broadcast_at_run_time, words):
    monkeypatch.setattr(exact, "WORDS", words)
    df = spark.createDataFrame(ROWS, "doc_id long, text string, n long").repartition(5)
    kept = exact.drop_copies(df)
    assert "shiftrightunsigned" in _plan(kept)  # asked before rows are moved
    kept = kept.collect()
    assert sorted(r.text.split()[1] for r in kept) == sorted(str(i) for i in range(400))
    assert all(r.doc_id == int(r.text.split()[1]) for r in kept)


def test_rows_that_are_told_are_always_found(spark, monkeypatch):
    hashed = "CASE WHEN n % 100 > 0 THEN n END AS id", "sha2(cast(n % 2900 AS string), 256) AS digest", "n"
    told, asked = spark.range(3000).toDF("n").selectExpr(*hashed), spark.range(9000).toDF("n").selectExpr(*hashed)
    for words, others in ((1, 6000), (1 << 10, 1800), (exact.WORDS, 300)):
        monkeypatch.setattr(exact, "WORDS", words)
        found = {r.n for r in asked.where(exact._may_be_in(told, asked.digest, asked.id)).select("n").collect()}
        assert found >= set(range(3000)) and len(found) - 3000 <= others
