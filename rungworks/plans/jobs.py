"""The daily jobs that keep the analytic tables: read, merge, write.

Run them in order: players, track, matches, then the daily tables.  Each can be
repeated at any time without effect.  Tables kept by day are read and replaced only
for the days a run touches.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rungworks import schemas
from rungworks.functions.scalars import since_days_date
from rungworks.operators import daily, pairs
from rungworks.operators.merge import rows_to_insert
from rungworks.plans import gold
from rungworks.plans.folded import fold_latest
from rungworks.plans.silver import set_aside
from rungworks.session import stage, staging
from rungworks.sources import tables


def _silver(spark: SparkSession, root: str, table: schemas.Table, **days) -> DataFrame:
    return tables.read_table(spark, f"{root}/{table.name}", table, **days)


def _first_day(as_of: str, days: int) -> date:
    return datetime.fromisoformat(as_of).date() - timedelta(days=days)


def build_players(spark: SparkSession, silver: str, gold_root: str, as_of: str) -> None:
    """The player dimension from the newest tags and names, which are kept; only changed days are read."""

    def newest(table: schemas.Table, rows: Callable[[DataFrame], DataFrame], keys: tuple[str, ...]) -> DataFrame:
        return fold_latest(spark, f"{silver}/{table.name}", table, f"{gold_root}/newest_{table.name}", rows, keys, "snapshot_ts")

    tags = newest(schemas.MODERN_LADDER_TEAMS, gold.tag_rows, gold.TAG_KEY)
    names = newest(schemas.LEGACY_LADDER_MEMBERS, gold.name_rows, gold.NAME_KEY)
    root = f"{gold_root}/{schemas.DIM_PLAYERS.name}"
    held = tables.read_version(spark, root, schemas.DIM_PLAYERS)
    tables.write_version(gold.merge_players(held, gold.named_players(tags, names), as_of), root)


def build_track(
    spark: SparkSession, silver: str, gold_root: str, as_of: str, days: int = gold.WINDOW_DAYS
) -> None:
    table, since = schemas.FACT_MMR_TRACK, _first_day(as_of, days)
    path = f"{gold_root}/{table.name}"
    modern = _silver(spark, silver, schemas.MODERN_LADDER_TEAMS, since=since)
    held = tables.read_table(spark, path, table, since=since)
    fresh = gold.rating_track_rows(held, modern, as_of, days)
    tables.append(fresh, path, table)


def build_matches(
    spark: SparkSession,
    silver: str,
    gold_root: str,
    as_of: str,
    days: int = gold.WINDOW_DAYS,
    match_type: str = gold.MATCH_TYPE,
) -> None:
    """Rebuild the window's matches and merge them into their days.

    The key of a match is made from its time, so a known match lies in the same day.
    Matches without an opponent go when the opponent has reported.
    Reports of the window without a map can have no key and go to the quarantine table.
    """
    table = schemas.FACT_MATCHES
    path = f"{gold_root}/{table.name}"
    history = _silver(spark, silver, schemas.MATCH_HISTORY)
    first = gold.earliest_match(history, as_of, days)
    if first is None:
        return
    history = _silver(spark, silver, schemas.MATCH_HISTORY, since=first.date())
    recent = history.where((F.col("type") == match_type) & since_days_date(F.col("snapshot_date"), as_of, days))
    columns = schemas.MATCH_HISTORY.payload
    set_aside(pairs.without_map(recent), table.name, F.lit("map: null"), columns, silver, as_of)
    current = stage(
        gold.match_facts(
            history,
            tables.read_table(spark, f"{gold_root}/{schemas.FACT_MMR_TRACK.name}", schemas.FACT_MMR_TRACK),
            tables.read_version(spark, f"{gold_root}/{schemas.DIM_PLAYERS.name}", schemas.DIM_PLAYERS),
            as_of,
            days,
            match_type,
            history_since=first,
        ),
        table.name,
    )
    held = tables.read_table(spark, path, table, tables.touched_days(current, "match_date"))
    tables.replace_days(gold.merge_matches(held, current, retract=True), path, table)


def build_daily(
    spark: SparkSession, silver: str, gold_root: str, as_of: str, days: int = gold.WINDOW_DAYS
) -> None:
    """Player statistics, rating checkpoints and daily ratings of the days in the window."""
    since = _first_day(as_of, days)
    history = _silver(spark, silver, schemas.MATCH_HISTORY)
    recent = history.where(since_days_date(F.col("snapshot_date"), as_of, days))
    played = _silver(spark, silver, schemas.MATCH_HISTORY, days=tables.touched_days(recent, "match_date"))
    stats = schemas.PLAYER_STATS_DAILY
    tables.replace_days(daily.player_stats_daily(played), f"{gold_root}/{stats.name}", stats)

    modern = _silver(spark, silver, schemas.MODERN_LADDER_TEAMS, since=since)
    legacy = _silver(spark, silver, schemas.LEGACY_LADDER_MEMBERS, since=since)
    checkpoints = schemas.MMR_CHECKPOINTS
    path = f"{gold_root}/{checkpoints.name}"
    found = daily.mmr_checkpoints(modern.withColumnRenamed("character_id", "profile_id"))
    held = tables.read_table(spark, path, checkpoints, since=since)
    tables.append(rows_to_insert(held, found, checkpoints.key), path, checkpoints)

    ratings = schemas.PLAYER_MMR_DAILY
    tables.replace_days(gold.player_mmr_daily(modern, legacy), f"{gold_root}/{ratings.name}", ratings)


def build_all(
    spark: SparkSession, silver: str, gold_root: str, as_of: str, days: int = gold.WINDOW_DAYS
) -> None:
    with staging(spark):
        build_players(spark, silver, gold_root, as_of)
        build_track(spark, silver, gold_root, as_of, days)
        build_matches(spark, silver, gold_root, as_of, days)
        build_daily(spark, silver, gold_root, as_of, days)
