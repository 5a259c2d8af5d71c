"""Change detection by counters: which keys moved since the state was last advanced."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.functions.scalars import moment, or_zero, truthy_number
from rungworks.operators.merge import INCOMING, upsert


def max_counter_first_seen(
    df: DataFrame, key: str, counter: Column, first_seen: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Per key the greatest counter, and the attributes of its first sighting under ``order``."""
    grouped = df.groupBy(key).agg(
        F.max(counter).alias("current_games"),
        F.min_by(F.struct(*first_seen), F.struct(*order)).alias("_first"),
    )
    return grouped.select(key, *[F.col(f"_first.{c}").alias(c) for c in first_seen], "current_games")


def current_counters(members: DataFrame) -> DataFrame:
    """Players of the newest ladder documents with their number of games.

    Players lacking an id, realm or region are left out; one seen in several
    ladders keeps the highest count and the place it was first seen in.
    """
    known = members.where(
        truthy_number(F.col("character_id"))
        & truthy_number(F.col("realm"))
        & truthy_number(F.col("region"))
    )
    return max_counter_first_seen(
        known,
        "character_id",
        or_zero(F.col("wins")) + or_zero(F.col("losses")),
        ["realm", "region"],
        ["league_id", "ladder_id", "member_pos", "realm", "region"],
    )


def _against(counters: DataFrame, state: DataFrame, key: str, total: str) -> DataFrame:
    known = state.select(key, F.col(total).alias("_known"))
    moved = (F.col("current_games") > 0) & (
        F.col("current_games") != F.coalesce("_known", F.lit(-1))
    )
    return counters.join(known, key, "left").withColumn("_moved", moved)


def changed_keys(
    counters: DataFrame, state: DataFrame, key: str = "character_id", total: str = "total_games"
) -> DataFrame:
    """Keys with a non-zero counter that differs from the state's, downwards included."""
    return _against(counters, state, key, total).where("_moved").select(*counters.columns)


def change_summary(
    counters: DataFrame, state: DataFrame, key: str = "character_id", total: str = "total_games"
) -> DataFrame:
    """One row: keys in all, changed, skipped, and whether the state was empty before."""
    seen = _against(counters, state, key, total).select(
        F.lit(1).alias("seen"), F.col("_moved").cast("int").alias("moved"), F.lit(0).alias("known")
    )
    known = state.select(F.lit(0).alias("seen"), F.lit(0).alias("moved"), F.lit(1).alias("known"))
    return seen.unionByName(known).agg(
        F.coalesce(F.sum("seen"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("moved"), F.lit(0)).alias("changed"),
        F.coalesce(F.sum(F.col("seen") - F.col("moved")), F.lit(0)).alias("skipped"),
        (F.coalesce(F.sum("known"), F.lit(0)) == 0).alias("first_run"),
    )


def advance_state(state: DataFrame, landed: DataFrame, as_of: datetime | str) -> DataFrame:
    """The state after the keys in ``landed`` were fetched: their totals replaced.

    Pass only keys whose records really arrived (an empty answer landed as an empty
    record counts), so that a failed fetch is tried again.
    """
    incoming = landed.select(
        "character_id",
        F.col("current_games").cast("int").alias("total_games"),
        moment(as_of).alias("updated_at"),
    )
    return upsert(
        state, incoming, ["character_id"], {"total_games": INCOMING, "updated_at": INCOMING}
    )
