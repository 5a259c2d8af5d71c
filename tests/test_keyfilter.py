"""Filters of keys: nothing held is missed, few others are reported, few days are opened."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rungworks import schemas
from rungworks.operators import flatten, keyfilter
from rungworks.plans import silver
from rungworks.sources import tables
from tests.helpers import rows

AT = "2026-03-08 00:00:00"


def _keys(spark, first, last, days=3):
    ids = spark.range(first, last).withColumn("t", F.expr(f"timestamp_ntz'2026-03-01' + make_dt_interval(id % {days}, 5)"))
    return ids.withColumn("name", F.when(F.col("id") % 7 > 0, F.concat(F.lit("n"), "id")))


def test_held_keys_are_reported_and_few_others(spark):
    held, others = _keys(spark, 0, 6000), _keys(spark, 6000, 30000)
    filters = keyfilter.build(held, "t", ["id", "name"]).unionByName(keyfilter.build(_keys(spark, 30000, 30050), "t", ["id", "name"]))
    found = keyfilter.possibly_held(held.unionByName(others), filters, "t", ["id", "name"])
    got = found.agg(F.count_if(F.col("id") < 6000).alias("held"), F.count_if(F.col("id") >= 6000).alias("false")).first()
    assert got.held == 6000 and got.false < 240
    assert filters.groupBy("day", "blocks").count().where("count > blocks").isEmpty()
    assert filters.count() < 6050 * keyfilter.BITS_PER_KEY / 256 + 20


def test_no_filters_no_rows_and_no_day_report_nothing(spark):
    held = _keys(spark, 0, 10)
    none = keyfilter.build(held.limit(0), "t", ["id"])
    assert none.isEmpty() and keyfilter.possibly_held(held, none, "t", ["id"]).isEmpty()
    undated = held.withColumn("t", F.lit(None).cast("timestamp_ntz"))
    assert keyfilter.build(undated, "t", ["id"]).isEmpty()


def _documents(spark, days, ladders):
    body = '{"ladder_id": "%d", "data": {"ladderMembers": [{"character": {"id": "%d", "realm": "1", "region": "1", "displayName": "p"}}]}}'
    made = [
        (f"legacy_ladders_raw_5_2026-03-{d:02d}_0000.json", body % (n, n)) for d in days for n in ladders
    ]
    texts = spark.createDataFrame(made, "file_name STRING, payload STRING")
    return flatten.parse_documents(texts, "payload", silver.LEGACY.document)


@pytest.fixture
def opened(monkeypatch):
    """Days that loads have opened, load by load."""
    seen, read = [], tables.read_table

    def spy(spark, path, table, days=None, since=None):
        if table is schemas.LEGACY_LADDER_MEMBERS and days is not None:
            seen.append([d.day for d in days])
        return read(spark, path, table, days, since)

    monkeypatch.setattr(tables, "read_table", spy)
    return seen


def test_a_load_opens_only_days_that_may_hold_its_keys(spark, tmp_path, opened):
    target = str(tmp_path / "silver")
    load = lambda days, ladders: silver.load(silver.LEGACY, _documents(spark, days, ladders), target, AT)
    assert load([1, 2, 3], [1, 2]) == (6, 6)
    assert load([1, 2, 3, 4], [3]) == (4, 4)
    assert load([2], [2, 3, 4]) == (3, 1)
    assert load([1, 4], [9]) == (2, 2)
    assert opened == [[], [], [2], []]
    table = tables.read_table(spark, f"{target}/legacy_ladder_members", schemas.LEGACY_LADDER_MEMBERS)
    assert table.count() == table.select("ladder_id", "snapshot_ts").distinct().count() == 13


def test_a_table_older_than_its_filters_is_read_by_days(spark, tmp_path, opened):
    target, table = str(tmp_path / "silver"), schemas.LEGACY_LADDER_MEMBERS
    docs = _documents(spark, [1, 2], [1])
    old = silver.prepare(silver.LEGACY, docs)[0].withColumn(table.audit, F.lit(datetime(2026, 3, 7)).cast("timestamp_ntz"))
    tables.append(old.where(F.to_date(table.time) == F.lit(date(2026, 3, 1))), f"{target}/{table.name}", table)
    assert silver.load(silver.LEGACY, docs, target, AT) == (2, 1)
    assert opened == [[1, 2]] and not tables.exists(spark, f"{target}/{table.name}-keys")
    assert len(rows(tables.read_table(spark, f"{target}/{table.name}", table), "ladder_id")) == 2
