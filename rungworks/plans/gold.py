"""Analytic tables: player dimension, rating track, matches, daily tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rungworks.functions.scalars import moment, since_days, since_days_date
from rungworks.operators import daily, inference, pairs
from rungworks.operators.latest import latest_per_key
from rungworks.operators.merge import (
    INCOMING,
    INCOMING_OR_TARGET,
    remember_previous,
    rows_to_insert,
    upsert,
)

# Days a run looks back, and the match type it rebuilds.
WINDOW_DAYS = 3
MATCH_TYPE = "1v1"

# What a later run may correct in a match already known.
INFERRED_COLUMNS = (
    "p1_race_inferred",
    "p1_race_confidence",
    "p2_race_inferred",
    "p2_race_confidence",
)


#: By what the newest tags, and the newest names, are found.
TAG_KEY = ("character_id", "race")
NAME_KEY = ("character_id",)


def tag_rows(modern: DataFrame) -> DataFrame:
    """What a snapshot of a ladder says of a character's race."""
    sound = modern.where(F.col("primary_race").isNotNull() & F.col("character_id").isNotNull())
    race = F.col("primary_race").alias("race")
    return sound.select("character_id", race, "battle_tag", "character_name", "snapshot_ts")


def name_rows(legacy: DataFrame) -> DataFrame:
    """What a snapshot of the members says of a character's name."""
    return legacy.where(F.col("character_id").isNotNull()).select("character_id", "display_name", "clan_tag", "snapshot_ts")


def named_players(tags: DataFrame, names: DataFrame) -> DataFrame:
    """The newest tags (:func:`tag_rows`) with the newest names, which win over those of the ladder."""
    return tags.join(names.drop("snapshot_ts"), "character_id", "left").select(
        "character_id",
        "race",
        "battle_tag",
        F.coalesce("display_name", "character_name").alias("display_name"),
        "clan_tag",
    )


def current_players(modern: DataFrame, legacy: DataFrame) -> DataFrame:
    """Newest tags and names of each (character, race); legacy names win over modern ones."""
    tags = latest_per_key(tag_rows(modern), TAG_KEY, "snapshot_ts")
    return named_players(tags, latest_per_key(name_rows(legacy), NAME_KEY, "snapshot_ts"))


def merge_players(dimension: DataFrame, current: DataFrame, as_of: str) -> DataFrame:
    """The dimension after a run: current values replaced, former names and clans remembered.

    Tag and name follow the newest snapshot even into null; a clan stays until
    another one is seen.
    """
    now = moment(as_of)
    today = now.cast("date")
    histories = [f for f in dimension.schema.fields if f.name in ("legacy_names", "legacy_clans")]
    nothing = {f.name: F.array().cast(f.dataType) for f in histories}
    return upsert(
        dimension,
        current.withColumn("updated_at", now),
        ["character_id", "race"],
        {
            "battle_tag": INCOMING,
            "display_name": INCOMING,
            "clan_tag": INCOMING_OR_TARGET,
            "legacy_names": remember_previous("display_name", "name", today, "legacy_names"),
            "legacy_clans": remember_previous("clan_tag", "clan", today, "legacy_clans"),
            "updated_at": INCOMING,
        },
        defaults=nothing,
    )


def rating_track_rows(track: DataFrame, modern: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    """Rows to append to the rating track: recent snapshots not yet in it.

    A character seen on several ladders at one moment keeps the lowest ladder.  Only
    the part of the track inside the window can hold such a key, so only it is read.
    """
    recent = modern.where(
        F.col("primary_race").isNotNull()
        & F.col("character_id").isNotNull()
        & since_days(F.col("snapshot_ts"), as_of, days)
    ).select(
        "character_id",
        F.col("primary_race").alias("race"),
        "snapshot_ts",
        "ladder_id",
        "rating",
        "wins",
        "losses",
    )
    held = track.where(since_days(F.col("snapshot_ts"), as_of, days))
    return rows_to_insert(held, recent, ["character_id", "race", "snapshot_ts"])


def earliest_match(history: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> datetime | None:
    """The earliest match reported in the window; no partner's report is older.

    For :func:`match_facts`' ``history_since``, when the history is kept by match time:
    one aggregate over the window spares the scan of everything before.
    """
    recent = history.where(since_days_date(F.col("snapshot_date"), as_of, days))
    return recent.agg(F.min("match_date")).first()[0]


def rebuilt_games(
    history: DataFrame,
    as_of: str,
    days: int = WINDOW_DAYS,
    match_type: str = MATCH_TYPE,
    history_since: datetime | None = None,
    **cut: int,
) -> DataFrame:
    """Pairs and unmatched reports of one match type, seen in the last ``days``.

    Partners may come from the whole history, or from ``history_since`` on.  ``cut`` is
    passed to :func:`pairs.games`.
    """
    reports = history.where(F.col("type") == match_type)
    if history_since:
        reports = reports.where(F.col("match_date") >= F.lit(history_since).cast("timestamp_ntz"))
    in_window = since_days_date(F.col("snapshot_date"), as_of, days)
    return pairs.games(pairs.game_reports(reports, in_window), **cut)


def inferred_games(
    games: DataFrame,
    track: DataFrame,
    players: DataFrame,
    evidence: DataFrame | None = None,
    tolerance: timedelta = inference.SESSION,
) -> DataFrame:
    """Games with each player's likely race and confidence.

    Without ``evidence`` nothing is boosted.  Evidence drawn from these games alone
    could not boost anything: a player is HIGH in all games or LOW in all, so no LOW
    game has an earlier HIGH game of the same player, and the lookup is left out.
    """
    ranked = inference.rank_candidates(games, inference.race_profiles(track, players))
    inferred = inference.with_confidence(ranked)
    return inferred if evidence is None else inference.boost(inferred, evidence, tolerance)


def match_facts(
    history: DataFrame,
    track: DataFrame,
    players: DataFrame,
    as_of: str,
    days: int = WINDOW_DAYS,
    match_type: str = MATCH_TYPE,
    evidence: DataFrame | None = None,
    tolerance: timedelta = inference.SESSION,
    history_since: datetime | None = None,
) -> DataFrame:
    """Match rows of the window, ready to be merged into the match table.

    Reports without a map pair with nothing and have no key; ``jobs.build_matches`` sets
    them aside (:func:`pairs.without_map`).
    """
    placed = history.where(F.col("map").isNotNull())
    games = rebuilt_games(placed, as_of, days, match_type, history_since)
    return inference.match_rows(inferred_games(games, track, players, evidence, tolerance))


def superseded(facts: DataFrame, current: DataFrame) -> DataFrame:
    """Ids of matches without an opponent whose player has one now, in a pair of the same time and map."""
    player = F.explode(F.array("p1_character_id", "p2_character_id")).alias("p1_character_id")
    paired = current.where(F.col("p2_character_id").isNotNull()).select("match_date", "map", player)
    alone = facts.where(F.col("p2_character_id").isNull())
    return alone.join(paired, ["match_date", "map", "p1_character_id"], "left_semi").select("match_id")


def merge_matches(facts: DataFrame, current: DataFrame, retract: bool = False) -> DataFrame:
    """The match table after a run: on a known match only races and confidence change.

    With ``retract``, a match without an opponent goes when its player's opponent has
    reported, since the pair has an id of its own.  ``facts`` then holds the days of ``current``.
    """
    held = facts.join(superseded(facts, current), "match_id", "left_anti") if retract else facts
    return upsert(held, current, ["match_id"], {c: INCOMING for c in INFERRED_COLUMNS})


player_stats_daily = daily.player_stats_daily
mmr_checkpoints = daily.mmr_checkpoints


def player_mmr_daily(modern: DataFrame, legacy: DataFrame) -> DataFrame:
    """Daily ratings from ladder snapshots, with the clan known at the end of each day.

    Both sides are reduced to one row per player and day before they meet.
    """
    snapshots = modern.withColumnRenamed("character_id", "profile_id")
    return daily.player_mmr_daily(snapshots).join(
        daily.last_clan_daily(legacy), ["profile_id", "snapshot_date"], "left"
    )
