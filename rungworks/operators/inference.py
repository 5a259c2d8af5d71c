"""Which race each player of a game probably played, and how sure that is.

A player's rated races are few, so they travel as one small array per player; the
best combination is then found inside the row.  Nothing is multiplied out and no
window over the games is needed.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.functions.scalars import match_key, or_zero
from rungworks.operators.asof import asof_lookup
from rungworks.operators.hotkeys import heavy_keys
from rungworks.operators.latest import latest_per_key
from rungworks.session import stage

# Confidence levels and the reach of a session's evidence.
HIGH, LOW, BOOSTED = "HIGH", "LOW", "BOOSTED"
SESSION = timedelta(minutes=90)


def latest_ratings(track: DataFrame) -> DataFrame:
    """Newest rating of each (character, race)."""
    newest = latest_per_key(
        track.select("character_id", "race", "snapshot_ts", "rating"),
        ["character_id", "race"],
        "snapshot_ts",
        tiebreak=[F.col("rating").desc_nulls_last()],
    )
    return newest.select("character_id", "race", "rating")


def race_counts(players: DataFrame) -> DataFrame:
    return players.groupBy("character_id").agg(F.countDistinct("race").alias("race_count"))


def race_profiles(track: DataFrame, players: DataFrame) -> DataFrame:
    """Per character: the rated races with their newest ratings, and the number of known races.

    The array has one entry per race the character is rated in, not per snapshot.
    """
    rated = (
        latest_ratings(track)
        .groupBy("character_id")
        .agg(F.collect_list(F.struct("race", "rating")).alias("ratings"))
    )
    return rated.join(race_counts(players), "character_id", "full_outer")


def _choices(ratings: Column) -> Column:
    nobody = F.array(F.struct(F.lit(None).cast("string"), F.lit(None).cast("int")))
    return F.coalesce(ratings, nobody.cast("array<struct<race:string,rating:bigint>>"))


def _best(p1: Column, p2: Column, alone: Column) -> Column:
    """Cheapest (cost, p1_race, p2_race); equal costs are settled by the races' names."""
    by_main_race = F.transform(
        _choices(p1),
        lambda a: F.struct(
            (-or_zero(a["rating"])).cast("bigint").alias("cost"),
            a["race"].alias("p1_race"),
            F.lit(None).cast("string").alias("p2_race"),
        ),
    )
    by_closest_rating = F.flatten(
        F.transform(
            _choices(p1),
            lambda a: F.transform(
                _choices(p2),
                lambda b: F.struct(
                    F.abs(or_zero(a["rating"]) - or_zero(b["rating"])).cast("bigint").alias("cost"),
                    a["race"].alias("p1_race"),
                    b["race"].alias("p2_race"),
                ),
            ),
        )
    )
    return F.when(alone, F.array_min(by_main_race)).otherwise(F.array_min(by_closest_rating))


def rank_candidates(all_games: DataFrame, profiles: DataFrame) -> DataFrame:
    """Add the best race combination and both players' race counts to each game.

    Against an opponent the pair of races with the closest ratings wins, alone the
    race rated highest; an unrated player counts as 0 and keeps a null race.
    """
    wide = profiles.select(
        "character_id",
        F.col("ratings").cast("array<struct<race:string,rating:bigint>>").alias("ratings"),
        "race_count",
    )
    one = wide.select([F.col(c).alias(f"p1_{c}") for c in wide.columns])
    two = wide.select([F.col(c).alias(f"p2_{c}") for c in wide.columns])
    # Games without a second player are spread by a stand-in key instead of all
    # meeting in the null partition; the extra condition keeps them unmatched.
    opponent = F.coalesce(
        F.col("p2_id").cast("bigint"), F.pmod(F.xxhash64("p1_id", "match_date", "map"), F.lit(2**31 - 1))
    )
    joined = (
        all_games.withColumn("_opponent", opponent)
        .join(one, F.col("p1_id") == F.col("p1_character_id"), "left")
        .join(
            two,
            (F.col("_opponent") == F.col("p2_character_id").cast("bigint")) & F.col("p2_id").isNotNull(),
            "left",
        )
    )
    best = _best(F.col("p1_ratings"), F.col("p2_ratings"), F.col("p2_id").isNull())
    return joined.withColumn("_best", best).select(
        *all_games.columns, "_best.*", "p1_race_count", "p2_race_count"
    )


def with_confidence(ranked: DataFrame) -> DataFrame:
    """HIGH if the dimension knows exactly one race of the player, LOW otherwise."""
    p1 = F.when(F.col("p1_race_count") == 1, HIGH).otherwise(LOW)
    p2 = F.when(F.col("p2_id").isNotNull(), F.when(F.col("p2_race_count") == 1, HIGH).otherwise(LOW))
    return ranked.withColumns({"p1_confidence": p1, "p2_confidence": p2})


def high_confidence_evidence(inferred: DataFrame) -> DataFrame:
    """(character_id, match_date, race) of every player classified HIGH with a race."""
    names = ("character_id", "race", "confidence")
    sides = F.array(
        *[
            F.struct(*[F.col(f"{p}_{c}").alias(n) for c, n in zip(("id", "race", "confidence"), names)])
            for p in ("p1", "p2")
        ]
    )
    rows = inferred.select("match_date", F.explode(sides).alias("s")).select("match_date", "s.*")
    sure = (F.col("confidence") == HIGH) & F.col("race").isNotNull()
    return rows.where(sure).select("character_id", "match_date", "race")


def _within_reach(evidence: DataFrame, games: DataFrame, tolerance: timedelta) -> DataFrame:
    """Evidence before the last game and no older than the tolerance before the first."""
    kind = dict(games.dtypes)["match_date"]
    ends = (F.min("match_date") - F.lit(tolerance), F.max("match_date"))
    since, before = games.agg(*[end.cast("string") for end in ends]).first()
    at = F.col("match_date")
    return evidence.where((at >= F.lit(since).cast(kind)) & (at < F.lit(before).cast(kind)))


def boost(inferred: DataFrame, evidence: DataFrame, tolerance: timedelta = SESSION) -> DataFrame:
    """Replace LOW races by the player's newest evidence before the game.

    ``evidence`` holds (character_id, match_date, race); what no game can reach, by its time, is
    left out before any of it moves.  The games are staged once: they feed the lookup and are
    joined to its answer twice.
    """
    games = stage(inferred, "inferred-games")
    evidence = _within_reach(evidence, games, tolerance)
    asked = F.array(
        F.when(F.col("p1_confidence") == LOW, F.col("p1_id")),
        F.when(F.col("p2_confidence") == LOW, F.col("p2_id")),
    )
    found = asof_lookup(
        games.select(F.explode(F.array_compact(asked)).alias("character_id"), "match_date"),
        evidence.select("character_id", F.col("match_date").alias("seen_at"), "race"),
        key="character_id",
        probe_ts="match_date",
        evidence_ts="seen_at",
        value="race",
        tolerance=tolerance,
        dense_keys=heavy_keys(evidence, "character_id"),
    ).select("character_id", "match_date", "race")
    out = games
    for p in ("p1", "p2"):
        side = found.select(
            F.col("character_id").alias("_id"), F.col("match_date").alias("_at"), F.col("race").alias("_race")
        )
        hit = (
            (F.col(f"{p}_id") == F.col("_id"))
            & (F.col("match_date") == F.col("_at"))
            & (F.col(f"{p}_confidence") == LOW)
        )
        confidence = F.when(F.col("_race").isNotNull(), BOOSTED).otherwise(F.col(f"{p}_confidence"))
        out = (
            out.join(side, hit, "left")
            .withColumns(
                {f"{p}_race": F.coalesce("_race", f"{p}_race"), f"{p}_confidence": confidence}
            )
            .drop("_id", "_at", "_race")
        )
    return out


def match_rows(inferred: DataFrame, key_separator: str = "") -> DataFrame:
    """Shape inferred games as rows of the match table; games need a map to have a key."""
    key = match_key(
        F.col("p1_id"), F.col("p2_id"), F.col("match_date"), F.col("map"), key_separator
    )
    return inferred.select(
        key.alias("match_id"),
        "match_date",
        "map",
        "type",
        F.col("p1_id").alias("p1_character_id"),
        "p1_decision",
        F.col("p1_race").alias("p1_race_inferred"),
        F.col("p1_confidence").alias("p1_race_confidence"),
        F.col("p2_id").alias("p2_character_id"),
        "p2_decision",
        F.col("p2_race").alias("p2_race_inferred"),
        F.col("p2_confidence").alias("p2_race_confidence"),
    )
