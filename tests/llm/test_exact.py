"""Exact copies: shares that exist, texts moved once, and digests that stand for several texts."""

import io
import random
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from rungworks.llm import exact


def _plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def _rows(seed, n=400):
    rng = random.Random(seed)
    texts = ["", " ", "a b", "a\tb", "a  b", None, *[f"text {i}" for i in range(60)], "the hot one"]
    return [(rng.choice([None, *range(90)]), rng.choice(texts[: rng.randrange(1, 68)] + ["the hot one"] * 20), i) for i in range(n)]


def _norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def _marks(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(_norm(t), []).append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((n, least[_norm(t)], len(groups[_norm(t)]), i == least[_norm(t)]) for i, t, n in rows), key=repr)


@pytest.mark.parametrize("weak", [False, True], ids=["digests", "digests that collide"])
def test_marks_and_what_stays(spark, monkeypatch, weak):
    if weak:
        monkeypatch.setattr(exact, "digest", lambda text: F.substring(F.sha2(text.cast("binary"), 256), 1, 1))
    rows = _rows(3)
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(7)
    got = sorted(((r.n, r.keep_id, r.group_size, r.kept) for r in exact.mark_copies(df).collect()), key=repr)
    assert got == _marks(rows)
    kept = exact.drop_copies(df).collect()
    assert len(kept) == len({_norm(t) for _, t, _ in rows}) == len({_norm(r.text) for r in kept})
    wanted = {_norm(t): keep for (_, t, n), (_, keep, _, _) in zip(rows, sorted(_marks(rows)), strict=True)}
    assert all(r.doc_id == wanted[_norm(r.text)] for r in kept)


def test_copies_are_dealt_by_share_and_texts_of_single_rows_stay(spark):
    df = spark.createDataFrame([(i, "hot") for i in range(3000)] + [(9000 + i, f"t{i}") for i in range(50)], "doc_id long, text string")
    held = exact.copies(df)
    assert held.count() == 3000
    plan = _plan(exact.groups(held))
    shares = [line for line in plan.splitlines() if "hashpartitioning(digest" in line and "salt" in line]
    assert shares, plan
    (salts,) = exact.groups(held).select("group_size").first()
    assert salts == 3000


def test_no_copies_no_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "doc_id long, text string")
    assert sorted(r.text for r in exact.drop_copies(df).collect()) == ["a", "b", "c"]
    assert exact.drop_copies(df.limit(0)).collect() == []
