"""Nested documents to flat rows.

Every flattener is inner: a parent whose list is empty, missing or null gives no
row.  Fields are read null-safely, so a half-filled document gives nulls.
All work is row-local (``explode`` and struct access), with no exchange.

What holds for a whole document is worked out before its lists are unrolled.  The
lists are unrolled as fields of a struct: for a bare list column Spark derives a
"not empty" filter and pushes it below the parsing step, parsing each text twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.functions import filenames
from rungworks.functions.scalars import epoch_seconds_to_ntz, whole


def parse_documents(df: DataFrame, text: str, schema: str) -> DataFrame:
    """Replace a JSON text column by the fields of ``schema``; other columns stay."""
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.from_json(text, schema).alias("_doc")).select(*kept, "_doc.*")


def league_divisions(docs: DataFrame) -> DataFrame:
    """One row per division; league key and tier fields repeat on each."""
    stamped = docs.select(
        filenames.snapshot_ts("file_name").alias("snapshot_ts"), "key", F.struct("tier").alias("doc")
    )
    tiers = stamped.select("snapshot_ts", "key", F.explode("doc.tier").alias("tier"))
    rows = tiers.select("snapshot_ts", "key", "tier", F.explode("tier.division").alias("division"))
    return rows.select(
        whole(F.col("key.season_id")).alias("season_id"),
        whole(F.col("key.queue_id")).alias("queue_id"),
        whole(F.col("key.league_id")).alias("league_id"),
        whole(F.col("key.team_type")).alias("team_type"),
        whole(F.col("tier.id")).alias("tier_id"),
        whole(F.col("tier.min_rating")).alias("tier_min_rating"),
        whole(F.col("tier.max_rating")).alias("tier_max_rating"),
        whole(F.col("division.id")).alias("division_id"),
        whole(F.col("division.ladder_id")).alias("ladder_id"),
        whole(F.col("division.member_count")).alias("member_count"),
        "snapshot_ts",
    )


_LADDER = ("league_id", "ladder_id", "snapshot_ts")


def _ladder(docs: DataFrame) -> DataFrame:
    return docs.select(
        filenames.league_id("file_name").cast("bigint").alias("league_id"),
        whole(F.col("ladder_id")).alias("ladder_id"),
        filenames.snapshot_ts("file_name").alias("snapshot_ts"),
        "data",
    )


def modern_ladder_teams(docs: DataFrame) -> DataFrame:
    """One row per team member; team fields repeat, the first played race is the primary one."""
    teams = _ladder(docs).select(*_LADDER, F.explode("data.team").alias("team"))
    rows = teams.select(*_LADDER, "team", F.explode("team.member").alias("member"))
    top = F.get("member.played_race_count", F.lit(0))
    numbers = (
        "rating", "wins", "losses", "ties", "points", "longest_win_streak", "current_win_streak",
        "current_rank", "highest_rank", "previous_rank", "join_time_stamp",
        "last_played_time_stamp",
    )
    return rows.select(
        "league_id",
        "ladder_id",
        F.col("team.id").alias("team_id"),
        *[whole(F.col(f"team.{c}")).alias(c) for c in numbers],
        whole(F.col("member.legacy_link.id")).alias("character_id"),
        whole(F.col("member.legacy_link.realm")).alias("character_realm"),
        F.col("member.legacy_link.name").alias("character_name"),
        F.col("member.character_link.battle_tag").alias("battle_tag"),
        top["race"]["en_US"].alias("primary_race"),
        whole(top["count"]).alias("primary_race_count"),
        "snapshot_ts",
    )


def legacy_ladder_members(docs: DataFrame) -> DataFrame:
    """One row per ladder member, camel-case fields renamed."""
    members = F.explode("data.ladderMembers").alias("member")
    return _legacy_columns(_ladder(docs).select(*_LADDER, members))


def _legacy_columns(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(
        "league_id",
        "ladder_id",
        whole(F.col("member.character.id")).alias("character_id"),
        whole(F.col("member.character.realm")).alias("realm"),
        whole(F.col("member.character.region")).alias("region"),
        F.col("member.character.displayName").alias("display_name"),
        F.col("member.character.clanName").alias("clan_name"),
        F.col("member.character.clanTag").alias("clan_tag"),
        F.col("member.character.profilePath").alias("profile_path"),
        whole(F.col("member.joinTimestamp")).alias("join_timestamp"),
        whole(F.col("member.points")).alias("points"),
        whole(F.col("member.wins")).alias("wins"),
        whole(F.col("member.losses")).alias("losses"),
        whole(F.col("member.highestRank")).alias("highest_rank"),
        whole(F.col("member.previousRank")).alias("previous_rank"),
        F.col("member.favoriteRaceP1").alias("favorite_race"),
        "snapshot_ts",
        *extra,
    )


def legacy_members_with_position(docs: DataFrame) -> DataFrame:
    """Ladder members with their place in the ladder, which ranks equal sightings."""
    members = F.posexplode("data.ladderMembers").alias("member_pos", "member")
    return _legacy_columns(_ladder(docs).select(*_LADDER, members), "member_pos")


def match_history(docs: DataFrame) -> DataFrame:
    """One row per match and requested player; epoch seconds become UTC wall time."""
    requests = docs.select(
        whole(F.col("request_profile_id")).alias("profile_id"),
        whole(F.col("request_realm_id")).alias("realm_id"),
        whole(F.col("request_region_id")).alias("region_id"),
        filenames.snapshot_date("file_name").alias("snapshot_date"),
        F.struct("matches").alias("doc"),
    )
    ids = ("profile_id", "realm_id", "region_id")
    rows = requests.select(*ids, "snapshot_date", F.explode("doc.matches").alias("match"))
    return rows.select(
        *ids,
        epoch_seconds_to_ntz(whole(F.col("match.date"))).alias("match_date"),
        F.col("match.map").alias("map"),
        F.col("match.type").alias("type"),
        F.col("match.decision").alias("decision"),
        F.col("match.speed").alias("speed"),
        "snapshot_date",
    )


def flatten_path(
    df: DataFrame,
    path: Sequence[str],
    meta: Mapping[str, str | Column] | None = None,
    record_prefix: str = "",
    meta_prefix: str = "",
    position: str | None = None,
) -> DataFrame:
    """Rows of a nested list, with chosen fields of its ancestors.

    ``path`` names the lists from the outside in.  ``meta`` maps an output name to
    a field: ``"key.season_id"`` is read from the document, ``"tier.id"`` from the
    element of the list ``tier`` the row came from.  The innermost elements must be
    structs; their fields are prefixed with ``record_prefix``.  With ``position``
    the index of the outermost list's element is added under that name.
    """
    scope = df
    names = [c for c in df.columns if c not in path]
    parent = ""
    for depth, name in enumerate(path):
        source = f"{parent}.{name}" if parent else name
        if depth == 0 and position:
            generator = F.posexplode(source).alias(position, f"_{name}")
            names = [*names, position]
            scope = scope.select(*[c for c in names if c != position], generator)
        else:
            scope = scope.select(*names, F.explode(source).alias(f"_{name}"))
        parent = f"_{name}"
        names = [*names, parent]

    def resolve(field: str | Column) -> Column:
        if isinstance(field, Column):
            return field
        head, _, tail = field.partition(".")
        return F.col(f"_{head}.{tail}") if head in path else F.col(field)

    fields = scope.schema[parent].dataType.names
    return scope.select(
        *[F.col(f"{parent}.{f}").alias(f"{record_prefix}{f}") for f in fields],
        *[resolve(f).alias(f"{meta_prefix}{out}") for out, f in (meta or {}).items()],
        *([position] if position else []),
    )


def child_ids(docs: DataFrame, parent_list: str, child_list: str, id_field: str, out: str) -> DataFrame:
    """Add the ids of all grandchildren of each document, in document order.

    The list is assembled inside the row it came from, so no group is collected.
    """
    ids = F.flatten(
        F.transform(
            F.filter(parent_list, lambda p: p[child_list].isNotNull()),
            lambda p: F.transform(p[child_list], lambda c: c[id_field]),
        )
    )
    return docs.withColumn(out, F.coalesce(ids, F.array().cast("array<string>")))
