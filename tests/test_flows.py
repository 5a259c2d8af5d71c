"""The registered flow query against keys counted by hand."""

import os
from datetime import datetime

import duckdb
import pytest

from rungworks.catalog import roles
from rungworks.catalog.queries import QUERIES
from rungworks.plans import silver

DATA = "/root/testdata/sf0.001"
AT = datetime(2001, 7, 3, 4, 5, 6)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_ladder_documents_are_loaded_at_their_real_times(spark):
    orders = duckdb.sql(f"SELECT o_custkey, o_orderkey, o_orderdate FROM '{DATA}/orders.parquet'").fetchall()
    keys = {(customer, who, at.strftime("%Y-%m-%d %H:%M")) for customer, order, at in orders for who in (customer, order)}
    by_month = {(customer, who, minute[:7]) for customer, who, minute in keys}
    assert len(by_month) < len(keys)
    got = {r.run: r for r in QUERIES["q30_load_flows"](spark, DATA).where("name = 'modern_ladder_teams'").collect()}
    assert [(got[n].processed, got[n].inserted, got[n].held) for n in (1, 2)] == [
        (2 * len(orders), len(keys), len(keys)), (2 * len(orders), 0, len(keys)),
    ]


def _tables(spark, root, *orders):
    """The tables that documents are made from: two orders of one customer, and those given."""
    given = {
        "orders": (
            [(1, 7, "O", 250.5, AT, "1-URGENT"), (2, 7, "P", 99.0, AT, "2-HIGH"), *orders],
            "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
        ),
        "customer": (
            [(7, "seven", 3, 6000.0, "TOOLS"), (8, "eight", 4, 10.0, "CARS")],
            "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
        ),
        "events": ([(1, 7, "purchase", AT), (2, 7, "error", AT)], "event_id LONG, user_id LONG, event_type STRING, ts TIMESTAMP_NTZ"),
    }
    for name, (values, columns) in given.items():
        spark.createDataFrame(values, columns).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toJSON()


def test_documents_loaded_twice_are_parsed_once(spark, tmp_path, monkeypatch):
    given, plans, load = _tables(spark, tmp_path / "given"), [], silver.load

    def spy(flow, docs, *rest):
        plans.append((flow.table.name, _plan(docs)))
        return load(flow, docs, *rest)

    monkeypatch.setattr(silver, "load", spy)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(f"{shared}/rungworks")) if os.path.isdir(f"{shared}/rungworks") else set()
    got = sorted(tuple(r) for r in QUERIES["q30_load_flows"](spark, given).collect())
    assert got == [
        ("league_divisions", 1, 2, 2, 2), ("league_divisions", 2, 2, 0, 2),
        ("legacy_ladder_members", 1, 3, 3, 3), ("legacy_ladder_members", 2, 3, 0, 3),
        ("match_history", 1, 2, 1, 1), ("match_history", 2, 2, 0, 1),
        ("modern_ladder_teams", 1, 4, 3, 3), ("modern_ladder_teams", 2, 4, 0, 3),
    ]
    assert len(plans) == 8 and not [name for name, plan in plans if "JsonToStructs" in plan]
    left = set(os.listdir(f"{shared}/rungworks")) - before
    assert [name.rsplit("-", 1)[0] for name in left] == ["load-flows"]


def test_ladder_documents_are_put_together_without_lambdas(spark, tmp_path):
    docs = roles.modern_documents(spark, _tables(spark, tmp_path, (3, None, None, 1.0, AT, "5-LOW")))
    assert "LambdaFunction" not in _plan(docs)
    counts = (
        '"wins":7,"losses":3,"ties":3,"points":%d,"longest_win_streak":184,"current_win_streak":7,"current_rank":184,'
        '"highest_rank":3,"previous_rank":2001,"join_time_stamp":994133106'
    )

    def text(ladder, rating, key, players):
        points = counts % (rating // 100)
        guest = '{"legacy_link":{"realm":1,"name":"guest"},"character_link":{"battle_tag":"guest#%d"},"played_race_count":[]}' % key
        return (
            f'{{{ladder}"data":{{"team":[{{"id":"{key}","rating":{rating},{points},"member":[{players}]}},'
            f'{{"id":"{key}",{points},"member":[]}},{{"id":"18446744073709551615",{points},"member":[{guest}]}}]}}}}'
        )

    def player(link, tag, races):
        return f'{{"legacy_link":{{{link}}},"character_link":{{{tag}}},"played_race_count":[{races}]}}'

    def second(key):
        return player(f'"id":{key},"realm":1,"name":"second"', f'"battle_tag":"second#{key}"', "")

    other = '{"race":{"en_US":"Random"},"count":1}'
    first = player('"id":7,"realm":1,"name":"O"', '"battle_tag":"O#1"', '{"race":{"en_US":"1-URGENT"},"count":7},' + other)
    nobody = player('"realm":1', "", '{"race":{"en_US":"5-LOW"}},' + other)
    got = {r.payload: r.file_name for r in docs.collect()}
    assert got[text('"ladder_id":7,', 250, 1, f"{first},{second(1)}")] == "modern_ladders_raw_8_2001-07-03_0405.json"
    assert got[text("", 1, 3, f"{nobody},{second(3)}")] == "modern_ladders_raw_2001-07-03_0405.json"
    assert len(got) == 3
