from datetime import datetime, timedelta

from tests.helpers import rows
from pyspark.sql import functions as F

from rungworks import schemas
from rungworks.operators.latest import first_n_per_key, latest_per_key
from rungworks.sources import listing


def _listing(spark, count, kind="league_raw", league=5):
    start = datetime(2026, 3, 1)
    names = [(f"{kind}_{league}_{start + timedelta(minutes=10 * i):%Y-%m-%d_%H%M}.json",) for i in range(count)]
    return spark.createDataFrame(names, "file_name STRING")


def test_last_files_and_backlog_per_family(spark):
    files = listing.describe(
        _listing(spark, 25).union(_listing(spark, 20, league=6)).union(_listing(spark, 3, "modern_ladders_raw"))
    )
    assert rows(listing.backlog(files, 10)) == [
        ("league_raw", 5, 25, 15, True), ("league_raw", 6, 20, 10, False), ("modern_ladders_raw", 5, 3, 0, False),
    ]
    assert listing.last_files(files).count() == 23
    assert listing.last_files(files, 2).where("league_id = 6").agg(F.min("file_name")).first()[0] == (
        "league_raw_6_2026-03-01_0300.json"
    )
    assert rows(listing.latest_file(files), "file_name") == [
        ("league_raw_5_2026-03-01_0400.json",),
        ("league_raw_6_2026-03-01_0310.json",),
        ("modern_ladders_raw_5_2026-03-01_0020.json",),
    ]


def test_ledger_is_idempotent(spark):
    files = listing.describe(_listing(spark, 3))
    ledger = schemas.PROCESSED_FILES.empty(spark)
    assert listing.unprocessed(files, ledger).count() == 3
    noted = ledger.unionByName(listing.ledger_entries(files.limit(2), ledger, "2026-03-02 00:00:00"))
    assert listing.unprocessed(files, noted).count() == 1
    assert listing.ledger_entries(files, noted, "2026-03-03 00:00:00").count() == 1


def test_list_files_reads_names_only(spark, write_json):
    write_json("league_raw_5_2026-03-07_0440.json", {})
    path = write_json("notes.json", {}).rsplit("/", 1)[0]
    files = listing.list_files(spark, path, "league_raw_*.json")
    assert rows(files, "file_name", "kind", "league_id") == [("league_raw_5_2026-03-07_0440.json", "league_raw", 5)]


def test_latest_rows_have_a_total_order(spark):
    at = datetime(2026, 1, 1)
    ddl = "k INT, ts TIMESTAMP_NTZ, v STRING"
    df = spark.createDataFrame([(1, at, "b"), (1, at, "a"), (1, datetime(2025, 1, 1), "0"), (2, None, "x")], ddl)
    assert rows(latest_per_key(df, ["k"], "ts")) == [(1, at, "a"), (2, None, "x")]
    assert rows(latest_per_key(df, ["k"], "ts", [F.col("v").desc()])) == [(1, at, "b"), (2, None, "x")]
    assert first_n_per_key(df, ["k"], [F.col("ts"), F.col("v")], 2).count() == 3


def test_every_map_task_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("timestamp").alias("ts"))
    plan = latest_per_key(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert plan.count("WindowGroupLimit") == 2
