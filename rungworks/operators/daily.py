"""Daily tables per player.  All are single partial aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def player_stats_daily(matches: DataFrame, win: str = "WIN", loss: str = "LOSS") -> DataFrame:
    """Games, wins, losses and win rate per player and day."""
    daily = matches.groupBy("profile_id", F.to_date("match_date").alias("match_date")).agg(
        F.count("*").alias("games"),
        F.count_if(F.col("decision") == win).alias("wins"),
        F.count_if(F.col("decision") == loss).alias("losses"),
    )
    return daily.withColumn("win_rate", F.try_divide("wins", "games"))


def mmr_checkpoints(snapshots: DataFrame) -> DataFrame:
    """Rating snapshots per ladder, player and time; of several ratings the lowest stays."""
    return snapshots.groupBy("ladder_id", "profile_id", "snapshot_ts").agg(
        F.min("rating").alias("rating")
    )


def player_mmr_daily(snapshots: DataFrame) -> DataFrame:
    """Highest and last rating of the day, with the battle tag of the last snapshot."""
    last = F.max_by(
        F.struct("rating", "battle_tag"), F.struct("snapshot_ts", "rating", "battle_tag")
    )
    daily = snapshots.groupBy("profile_id", F.to_date("snapshot_ts").alias("snapshot_date")).agg(
        F.max("rating").alias("max_rating"), last.alias("_last")
    )
    return daily.select(
        "profile_id",
        "snapshot_date",
        "max_rating",
        F.col("_last.rating").alias("current_rating"),
        F.col("_last.battle_tag").alias("battle_tag"),
    )


def last_clan_daily(members: DataFrame) -> DataFrame:
    """The clan tag last seen on each day."""
    return members.groupBy(
        F.col("character_id").alias("profile_id"), F.to_date("snapshot_ts").alias("snapshot_date")
    ).agg(F.max_by("clan_tag", F.struct("snapshot_ts", "clan_tag")).alias("clan_tag"))
