from datetime import date, datetime

from rungworks.functions import filenames
from rungworks.functions.scalars import epoch_seconds_to_ntz, match_key, micros, whole
from pyspark.sql import functions as F
import pytest


def _parsed(spark, name):
    df = spark.createDataFrame([(name,)], "n STRING")
    return df.select(
        filenames.kind("n"), filenames.league_id("n"), filenames.snapshot_ts("n"), filenames.snapshot_date("n")
    ).first()


@pytest.mark.parametrize(
    "name, kind, league",
    [
        ("modern_ladders_raw_5_2026-03-07_0440.json", "modern_ladders_raw", 5),
        ("modern_ladders_raw_2026-03-07_0440.json", "modern_ladders_raw", 4),
        ("/lake/bronze/league_raw_6_2026-03-07_0440.json", "league_raw", 6),
        ("league_raw_6_2026-03-07_0440", "league_raw", 6),
        ("matches_all_history_2026-03-07_0440.json", "matches_all_history", 4),
    ],
)
def test_names_tell_kind_league_and_time(spark, name, kind, league):
    assert tuple(_parsed(spark, name)) == (
        kind, league, datetime(2026, 3, 7, 4, 40), date(2026, 3, 7),
    )


def test_other_names_give_null_and_the_default_league(spark):
    assert tuple(_parsed(spark, "notes.json")) == (None, 4, None, None)


def test_composed_names_parse_back(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2026-03-07 04:40:31' AS ts")
    name = filenames.document_name(F.lit("league_raw"), F.lit(3), F.col("ts"))
    assert df.select(name).first()[0] == "league_raw_3_2026-03-07_0440.json"


def test_epoch_is_utc_wall_time_in_any_zone(spark):
    df = spark.createDataFrame([(1741487400,), (0,), (None,)], "s BIGINT")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = epoch_seconds_to_ntz(F.col("s"))
        got = [tuple(r) for r in df.select(ts, micros(ts)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    # That wall time does not exist in New York.
    assert got == [(datetime(2025, 3, 9, 2, 30), 1741487400000000), (None, None), (None, None)]


def test_whole_numbers_from_text(spark):
    df = spark.createDataFrame([("7",), ("7.0",), (None,), ("18446744073709551",)], "v STRING")
    assert [r[0] for r in df.select(whole(F.col("v"))).collect()] == [7, 7, None, 18446744073709551]
    for bad in ("7.5", "x", ""):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            spark.createDataFrame([(bad,)], "v STRING").select(whole(F.col("v"))).collect()


def test_match_key_and_its_separator(spark):
    df = spark.sql("SELECT 12 AS a, 3 AS b, 1 AS c, 23 AS d, TIMESTAMP_NTZ'2025-01-01 00:00:00' AS t, 'Dusk' AS m")

    def key(a, b, sep=""):
        return match_key(F.col(a), F.col(b), F.col("t"), F.col("m"), sep)

    plain, other, apart, distinct = df.select(
        key("a", "b"), key("c", "d"), key("a", "b", "|"), key("c", "d", "|")
    ).first()
    assert plain == other and apart != distinct
    assert df.select(match_key(F.col("a"), F.col("b"), F.col("t"), F.lit(None).cast("string"))).first()[0] is None
