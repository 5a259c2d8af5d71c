"""Shapes of the raw documents and of the tables built from them.

All whole numbers of a raw document are declared ``STRING`` and cast when the
document is flattened: ids then survive at any width, digits delivered as text
are accepted, and text that is no number raises under ANSI casts, where a
``BIGINT`` field of the JSON reader would turn silently into null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------- documents

LEAGUE_DOCUMENT = """
    key STRUCT<season_id STRING, queue_id STRING, team_type STRING, league_id STRING>,
    tier ARRAY<STRUCT<id STRING, min_rating STRING, max_rating STRING,
        division ARRAY<STRUCT<id STRING, ladder_id STRING, member_count STRING>>>>
"""

MODERN_LADDER_DOCUMENT = """
    ladder_id STRING,
    data STRUCT<team ARRAY<STRUCT<
        id STRING, rating STRING, wins STRING, losses STRING, ties STRING, points STRING,
        longest_win_streak STRING, current_win_streak STRING,
        current_rank STRING, highest_rank STRING, previous_rank STRING,
        join_time_stamp STRING, last_played_time_stamp STRING,
        member ARRAY<STRUCT<
            legacy_link STRUCT<id STRING, realm STRING, name STRING>,
            character_link STRUCT<battle_tag STRING>,
            played_race_count ARRAY<STRUCT<race STRUCT<en_US STRING>, count STRING>>>>>>>
"""

LEGACY_LADDER_DOCUMENT = """
    ladder_id STRING,
    data STRUCT<ladderMembers ARRAY<STRUCT<
        character STRUCT<id STRING, realm STRING, region STRING, displayName STRING,
                         clanName STRING, clanTag STRING, profilePath STRING>,
        joinTimestamp STRING, points STRING, wins STRING, losses STRING,
        highestRank STRING, previousRank STRING, favoriteRaceP1 STRING>>>
"""

MATCH_HISTORY_DOCUMENT = """
    request_profile_id STRING, request_realm_id STRING, request_region_id STRING,
    matches ARRAY<STRUCT<date STRING, map STRING, type STRING, decision STRING, speed STRING>>
"""


# ------------------------------------------------------------------- tables


@dataclass(frozen=True)
class Table:
    """A table's columns, key and not-null columns.

    ``drop_if_null`` names the key parts whose absence makes a row meaningless
    rather than wrong: such rows are left out before the other checks run.
    ``time`` is the column by whose day the table is kept in folders.  The key holds
    or, for matches, is made from it, so rows of one key always share a folder.
    """

    name: str
    columns: str
    key: tuple[str, ...]
    required: tuple[str, ...]
    drop_if_null: tuple[str, ...] = ()
    audit: str | None = None
    time: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def payload(self) -> list[str]:
        """All columns but the audit column."""
        return [c for c in self.schema.names if c != self.audit]

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the table's payload columns, cast to the declared types.

        Under ANSI a value outside a column's range raises, as a database would.
        """
        types = {f.name: f.dataType for f in self.schema.fields}
        return df.select([F.col(c).cast(types[c]).alias(c) for c in self.payload])


LEAGUE_DIVISIONS = Table(
    name="league_divisions",
    columns="""
        season_id SMALLINT, queue_id SMALLINT, league_id SMALLINT, team_type SMALLINT,
        tier_id SMALLINT, tier_min_rating INT, tier_max_rating INT, division_id INT,
        ladder_id INT, member_count SMALLINT, snapshot_ts TIMESTAMP_NTZ, loaded_at TIMESTAMP_NTZ
    """,
    key=("ladder_id", "snapshot_ts"),
    required=("ladder_id", "snapshot_ts"),
    audit="loaded_at",
    time="snapshot_ts",
)

MODERN_LADDER_TEAMS = Table(
    name="modern_ladder_teams",
    columns="""
        league_id SMALLINT, ladder_id INT, team_id STRING, rating INT, wins INT, losses INT,
        ties INT, points INT, longest_win_streak INT, current_win_streak INT, current_rank INT,
        highest_rank INT, previous_rank INT, join_time_stamp BIGINT, last_played_time_stamp BIGINT,
        character_id INT, character_realm SMALLINT, character_name STRING, battle_tag STRING,
        primary_race STRING, primary_race_count INT, snapshot_ts TIMESTAMP_NTZ,
        loaded_at TIMESTAMP_NTZ
    """,
    key=("ladder_id", "character_id", "snapshot_ts"),
    required=("ladder_id", "character_id", "snapshot_ts"),
    drop_if_null=("character_id",),
    audit="loaded_at",
    time="snapshot_ts",
)

LEGACY_LADDER_MEMBERS = Table(
    name="legacy_ladder_members",
    columns="""
        league_id SMALLINT, ladder_id INT, character_id INT, realm SMALLINT, region SMALLINT,
        display_name STRING, clan_name STRING, clan_tag STRING, profile_path STRING,
        join_timestamp BIGINT, points INT, wins INT, losses INT, highest_rank INT,
        previous_rank INT, favorite_race STRING, snapshot_ts TIMESTAMP_NTZ, loaded_at TIMESTAMP_NTZ
    """,
    key=("ladder_id", "character_id", "snapshot_ts"),
    required=("ladder_id", "character_id", "snapshot_ts"),
    drop_if_null=("character_id",),
    audit="loaded_at",
    time="snapshot_ts",
)

MATCH_HISTORY = Table(
    name="match_history",
    columns="""
        profile_id INT, realm_id SMALLINT, region_id SMALLINT, match_date TIMESTAMP_NTZ,
        map STRING, type STRING, decision STRING, speed STRING, snapshot_date DATE,
        loaded_at TIMESTAMP_NTZ
    """,
    key=("profile_id", "realm_id", "region_id", "match_date"),
    required=("profile_id", "realm_id", "region_id", "match_date", "snapshot_date"),
    drop_if_null=("profile_id", "match_date"),
    audit="loaded_at",
    time="match_date",
)

PROCESSED_FILES = Table(
    name="processed_files",
    columns="filename STRING, processed_at TIMESTAMP_NTZ",
    key=("filename",),
    required=("filename",),
    audit="processed_at",
)

MATCH_HISTORY_CHECKPOINT = Table(
    name="match_history_checkpoint",
    columns="character_id INT, total_games INT, updated_at TIMESTAMP_NTZ",
    key=("character_id",),
    required=("character_id", "total_games"),
    audit="updated_at",
)

QUARANTINE = Table(
    name="quarantine",
    columns="source STRING, violation STRING, content STRING, loaded_at TIMESTAMP_NTZ",
    key=(),
    required=("source", "violation"),
    audit="loaded_at",
)

DIM_PLAYERS = Table(
    name="dim_players",
    columns="""
        character_id INT, race STRING, battle_tag STRING, display_name STRING, clan_tag STRING,
        legacy_names ARRAY<STRUCT<name STRING, since STRING>>,
        legacy_clans ARRAY<STRUCT<clan STRING, since STRING>>,
        updated_at TIMESTAMP_NTZ
    """,
    key=("character_id", "race"),
    required=("character_id", "race", "legacy_names", "legacy_clans"),
    audit="updated_at",
)

FACT_MMR_TRACK = Table(
    name="fact_mmr_track",
    columns="""
        character_id INT, race STRING, snapshot_ts TIMESTAMP_NTZ,
        ladder_id INT, rating INT, wins INT, losses INT
    """,
    key=("character_id", "race", "snapshot_ts"),
    required=("character_id", "race", "snapshot_ts"),
    time="snapshot_ts",
)

FACT_MATCHES = Table(
    name="fact_matches",
    columns="""
        match_id STRING, match_date TIMESTAMP_NTZ, map STRING, type STRING,
        p1_character_id INT, p1_decision STRING, p1_race_inferred STRING, p1_race_confidence STRING,
        p2_character_id INT, p2_decision STRING, p2_race_inferred STRING, p2_race_confidence STRING
    """,
    key=("match_id",),
    required=("match_id", "match_date", "p1_character_id"),
    time="match_date",
)

PLAYER_STATS_DAILY = Table(
    name="player_stats_daily",
    columns="""
        profile_id INT, match_date DATE, games BIGINT, wins BIGINT, losses BIGINT, win_rate DOUBLE
    """,
    key=("profile_id", "match_date"),
    required=("profile_id", "match_date"),
    time="match_date",
)

MMR_CHECKPOINTS = Table(
    name="mmr_checkpoints",
    columns="ladder_id INT, profile_id INT, snapshot_ts TIMESTAMP_NTZ, rating INT",
    key=("ladder_id", "profile_id", "snapshot_ts"),
    required=("ladder_id", "profile_id", "snapshot_ts"),
    time="snapshot_ts",
)

PLAYER_MMR_DAILY = Table(
    name="player_mmr_daily",
    columns="""
        profile_id INT, snapshot_date DATE, max_rating INT, current_rating INT,
        battle_tag STRING, clan_tag STRING
    """,
    key=("profile_id", "snapshot_date"),
    required=("profile_id", "snapshot_date"),
    time="snapshot_date",
)

SILVER = (
    LEAGUE_DIVISIONS,
    MODERN_LADDER_TEAMS,
    LEGACY_LADDER_MEMBERS,
    MATCH_HISTORY,
    PROCESSED_FILES,
    MATCH_HISTORY_CHECKPOINT,
    QUARANTINE,
)
GOLD = (
    DIM_PLAYERS,
    FACT_MMR_TRACK,
    FACT_MATCHES,
    PLAYER_STATS_DAILY,
    MMR_CHECKPOINTS,
    PLAYER_MMR_DAILY,
)
