"""Landing fetched payloads: check them, wrap them with what was asked for, write them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rungworks.functions.scalars import moment
from rungworks.operators import contracts
from rungworks.sources import documents


@dataclass(frozen=True)
class Landing:
    """A kind of response: its contract and how a payload is tied to its request.

    ``key`` puts the payload under ``data`` beside the id it was asked for;
    ``request_ids`` adds the ids to the payload as ``request_*`` fields.
    """

    kind: str
    contract: str
    key: str | None = None
    request_ids: tuple[str, ...] = ()
    skip_empty: str | None = None


# The four kinds of response.
LEAGUE = Landing("league_raw", "league")
MODERN = Landing("modern_ladders_raw", "modern_ladder", key="ladder_id")
LEGACY = Landing("legacy_ladders_raw", "legacy_ladder", key="ladder_id")
MATCHES = Landing(
    "matches_all_history",
    "match_history",
    request_ids=("profile_id", "realm_id", "region_id"),
    skip_empty="matches",
)


def checked_responses(landing: Landing, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound responses with their payload tied to the request, quarantined ones).

    ``responses`` has the payload as text in ``payload`` beside the request's columns.
    """
    if landing.skip_empty:
        responses = contracts.without_empty_results(responses, "payload", landing.skip_empty)
    sound, broken = contracts.split(contracts.check_payloads(responses, "payload", landing.contract))
    if landing.key:
        sound = documents.with_key(sound, landing.key, "payload")
    if landing.request_ids:
        sound = documents.with_request_ids(sound, landing.request_ids, "payload")
    return sound, broken


def land_responses(
    landing: Landing,
    responses: DataFrame,
    bronze: str,
    as_of: str,
    league: str | None = None,
) -> DataFrame:
    """Land the sound responses of a run and return the quarantined ones.

    A broken payload never stops the others; a run in which nothing at all is sound
    raises.  :func:`missing_partitions` tells which leagues got nothing.
    """
    sound, broken = checked_responses(landing, responses)
    contracts.require_any(sound, f"sound {landing.kind} payload")
    stamped = sound.withColumn("_taken", moment(as_of))
    documents.land(stamped, bronze, landing.kind, "payload", "_taken", league)
    return broken


def missing_partitions(sound: DataFrame, league: str, wanted: Sequence[int]) -> DataFrame:
    """Leagues of ``wanted`` without any sound response."""
    spark = sound.sparkSession
    asked = spark.createDataFrame([(w,) for w in wanted], f"{league} INT")
    return asked.join(sound.select(F.col(league).cast("int").alias(league)), league, "left_anti")
