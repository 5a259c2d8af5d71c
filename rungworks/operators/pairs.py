"""Rebuilding games from what each player reports about them.

Two reports describe one game if time, map and type agree and the decisions
differ.  Reports are first reduced to one row per player and game, which is all
the pairing needs: of a set of decisions only the least and the greatest matter
for "is there a differing pair".  One self-join then yields both the pairs and the
reports nobody matched.

Games are counted first, exactly.  Crowded ones go a way of their own, on which no
task ever holds one whole: repeated reports merge before the shuffle, and the pairs of a
game are formed in as many parts as their number asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.operators import hotkeys
from rungworks.session import stage

GAME = ("match_date", "map", "type")

# The same as join key: a hash to sort by, and what the hash stands for.
SAME_GAME = ("game", "match_date", "place")


def _place() -> Column:
    """Map and type as one text, never null; its end tells how long the type in it is.

    Reports without a map get a place of their own, keyed by player, instead of all
    meeting in one null partition.  As the value is never null, Spark derives no
    extra filter for one side of the self-join, and both sides read one shuffle.
    """
    kind = F.concat(F.col("type"), F.lit(":"), F.length("type").cast("string"))
    somewhere = F.concat(F.col("map"), F.lit("@"), kind)
    nowhere = F.concat(F.col("profile_id").cast("string"), F.lit("?"), kind)
    return F.coalesce(somewhere, nowhere, F.lit(""))


def game_reports(history: DataFrame, in_window: Column) -> DataFrame:
    """Reports with the key of their game and whether they lie in the window.

    Rows without a player, time or type are no reports and are left out.
    """
    reports = history.where(
        F.col("profile_id").isNotNull() & F.col("match_date").isNotNull() & F.col("type").isNotNull()
    ).select("profile_id", *GAME, _place().alias("place"), "decision", in_window.alias("in_window"))
    return reports.withColumn("game", F.xxhash64("match_date", "place"))


def window_games(reports: DataFrame) -> DataFrame:
    """Games with a report in the window, and the number of reports of each; no others can matter.

    Staged: one row per game of the window, which both ways of pairing look up.  Spark
    joins it by its measured size.
    """
    seen = reports.groupBy(*SAME_GAME).agg(F.count("*").alias("reports"), F.max("in_window").alias("wanted"))
    return stage(seen.where("wanted").select(*SAME_GAME, "reports"), "window-games")


def player_games(reports: DataFrame, *more: str) -> DataFrame:
    """One row per player and game: the range of its decisions, overall and in the window."""
    return reports.groupBy(*SAME_GAME, "profile_id", "map", *more).agg(
        F.first("type").alias("type"),
        F.min("decision").alias("any_lo"),
        F.max("decision").alias("any_hi"),
        F.min(F.when(F.col("in_window"), F.col("decision"))).alias("win_lo"),
        F.max(F.when(F.col("in_window"), F.col("decision"))).alias("win_hi"),
        F.max("in_window").alias("in_window"),
    )


def _differ(a: str, a_range: str, b: str, b_range: str) -> Column:
    """Some decision of ``a`` differs from some decision of ``b``; false if either has none."""
    return (F.col(f"{a}.{a_range}_lo") != F.col(f"{b}.{b_range}_hi")) | (
        F.col(f"{a}.{a_range}_hi") != F.col(f"{b}.{b_range}_lo")
    )


def games(
    reports: DataFrame, crowded: int = hotkeys.CROWDED, pairs_per_part: int = hotkeys.PAIRS_PER_PART
) -> DataFrame:
    """Pairs, and unmatched reports with an empty second player.

    The lower id comes first and must lie in the window; its partner may come from
    the whole history.  A player in the window who is in no pair of that game, on
    either side, stands alone.  Reports without a map never pair.

    Games of more than ``crowded`` reports are cut into parts on the first side and
    repeated on the second.  Which rows come out does not depend on that.
    """
    wanted = window_games(reports)
    on = list(SAME_GAME)
    # As a rule reports are shuffled and sorted once, by game: the reduction and both sides
    # of the pairing run on that layout.
    plain = reports.join(wanted.where(F.col("reports") <= crowded).select(*on), on, "left_semi")
    players = player_games(plain.repartition(*on))
    # Crowded games are few (at most rows / crowded); their reports merge before the shuffle.
    cut = hotkeys.parts(F.col("reports"), pairs_per_part).alias("parts")
    many = stage(wanted.where(F.col("reports") > crowded).select(*on, cut), "crowded-games")
    crowd = player_games(reports.join(many, on), "parts")
    own_part = F.pmod(F.xxhash64("profile_id"), F.col("parts"))
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    split = _paired(crowd.withColumn("part", own_part), crowd.withColumn("part", every_part), [*on, "part"])
    return _paired(players, players, on).unionByName(split)


def _paired(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in keys]
    first = first.where("in_window")
    a_id, b_id = F.col("a.profile_id"), F.col("b.profile_id")
    as_first = (a_id < b_id) & _differ("a", "win", "b", "any")
    as_second = (b_id < a_id) & F.col("b.in_window") & _differ("b", "win", "a", "any")
    # Of several decisions a player reported, the rule takes a pair that differs.
    low_first = F.col("a.win_lo") != F.col("b.any_hi")
    alone = b_id.isNull()
    p1_decision = F.when(alone | low_first, F.col("a.win_lo")).otherwise(F.col("a.win_hi"))
    p2_decision = F.when(low_first, F.col("b.any_hi")).otherwise(F.col("b.any_lo"))
    return (
        first.alias("a")
        .join(second.alias("b"), [*on, as_first | as_second], "left_outer")
        .where(alone | (a_id < b_id))
        .select(
            a_id.alias("p1_id"),
            b_id.alias("p2_id"),
            F.col("a.match_date").alias("match_date"),
            F.col("a.map").alias("map"),
            # Equal on both sides; naming both keeps the sides' plans, and so their shuffle, one.
            F.coalesce("a.type", "b.type").alias("type"),
            p1_decision.alias("p1_decision"),
            p2_decision.alias("p2_decision"),
        )
    )


def matched(all_games: DataFrame) -> DataFrame:
    return all_games.where(F.col("p2_id").isNotNull())


def unmatched(all_games: DataFrame) -> DataFrame:
    return all_games.where(F.col("p2_id").isNull())


def participants(all_games: DataFrame) -> DataFrame:
    """One row per player of each game: (profile_id, match_date, map)."""
    player = F.explode(F.array_compact(F.array("p1_id", "p2_id"))).alias("profile_id")
    return all_games.select(player, "match_date", "map")


def without_map(history: DataFrame) -> DataFrame:
    """Reports that can have no match key, for the quarantine."""
    return history.where(F.col("map").isNull())
