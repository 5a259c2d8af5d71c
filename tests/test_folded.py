"""Newest rows kept up to date from the days that changed."""

import random
from datetime import datetime, timedelta

from tests.helpers import rows

from rungworks import schemas
from rungworks.operators.latest import latest_per_key
from rungworks.plans.folded import fold_distinct, fold_latest
from rungworks.sources import tables

TABLE = schemas.Table("t", "k INT, t TIMESTAMP_NTZ, v STRING", ("k",), ("k",), time="t")
AT = datetime(2026, 1, 1)


def test_folds_equal_a_full_scan_and_read_changed_days_only(spark, tmp_path):
    rng, path, state = random.Random(6), str(tmp_path / "t"), str(tmp_path / "newest")
    read = []

    def look(df):
        read.append({str(d) for d in tables.touched_days(df, "t")})
        return df

    def fold():
        return fold_latest(spark, path, TABLE, state, look, ["k"], "t")

    assert fold().isEmpty()
    for days in ([0, 1, 2], [2, 3], [1], [9]):
        values = [(rng.randrange(12), AT + timedelta(days=rng.choice(days), minutes=rng.randrange(3)), rng.choice("abc")) for _ in range(30)]
        df = spark.createDataFrame(values, TABLE.schema)
        touched = tables.touched_days(df, "t")
        tables.note_days(spark, path, touched)
        tables.append(df, path, TABLE)
        got = rows(fold())
        assert got == rows(latest_per_key(tables.read_table(spark, path, TABLE), ["k"], "t"))
        assert read[-1] == {str(d) for d in touched}
        assert rows(fold()) == got and read[-1] == set()  # nothing noted, nothing read


def test_a_lost_state_is_made_anew_and_vain_notes_do_no_harm(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.createDataFrame([(1, AT, "a"), (1, AT + timedelta(days=1), "b")], TABLE.schema), path, TABLE)
    fold = lambda state: rows(fold_latest(spark, path, TABLE, str(tmp_path / state), lambda df: df, ["k"], "t"), "k", "v")
    assert fold("one") == [(1, "b")]
    tables.note_days(spark, path, [(AT + timedelta(days=5)).date()])
    assert fold("one") == [(1, "b")] == fold("two")


def test_distinct_rows_are_kept_over_runs(spark, tmp_path):
    path, all_rows = str(tmp_path / "t"), set()
    for run, days in enumerate(([0, 1], [1, 2], [0])):
        values = [(k, AT + timedelta(days=d), v) for d in days for k, v in ((1, "a"), (run, "b"), (2, "c" * run or None))]
        tables.note_days(spark, path, [(AT + timedelta(days=d)).date() for d in days])
        tables.append(spark.createDataFrame(values, TABLE.schema), path, TABLE)
        all_rows |= {(k, v) for k, _, v in values}
        found = fold_distinct(spark, path, TABLE, str(tmp_path / "state"), lambda df: df.select("k", "v"))
        assert rows(found) == sorted(all_rows, key=repr)
