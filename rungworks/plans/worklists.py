"""Lists that drive the next fetch: ladders of a league, and players with new games."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rungworks import schemas
from rungworks.functions import filenames
from rungworks.operators.changes import advance_state, changed_keys, current_counters
from rungworks.operators.flatten import child_ids, legacy_members_with_position
from rungworks.session import stage
from rungworks.sources import tables
from rungworks.sources.listing import latest_snapshot


def ladder_worklist(league_docs: DataFrame) -> DataFrame:
    """(league_id, position, ladder_id) from each league's newest structure document.

    One row per ladder, numbered in document order: the list of a league can be of
    any length without ever being held in one place.
    """
    stamped = league_docs.withColumns(
        {
            "league_id": filenames.league_id("file_name"),
            "snapshot_ts": filenames.snapshot_ts("file_name"),
        }
    )
    newest = latest_snapshot(stamped, "league_id")
    listed = child_ids(newest, "tier", "division", "ladder_id", "ladder_ids")
    return listed.select("league_id", F.posexplode("ladder_ids").alias("position", "ladder_id"))


def newest_counters(legacy_docs: DataFrame) -> DataFrame:
    """Players' game counts from each league's newest ladder documents, whatever else there is."""
    stamped = legacy_docs.withColumns(
        {
            "_league": filenames.league_id("file_name"),
            "_ts": filenames.snapshot_ts("file_name"),
        }
    )
    newest = latest_snapshot(stamped, "_league", "_ts")
    return current_counters(legacy_members_with_position(newest))


def changed_players(legacy_docs: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Players of each league's newest ladder document whose game count moved."""
    return changed_keys(newest_counters(legacy_docs), checkpoint)


def fetch_changed(
    legacy_docs: DataFrame, state_root: str, fetch: Callable[[DataFrame], DataFrame], as_of: str
) -> DataFrame:
    """One run of the daily fetch: list the changed players, fetch them, advance the state.

    ``fetch`` gets the list and returns the ``character_id`` of the players whose records
    arrived; only their totals enter the state, so the others are listed again by the
    next run.  Returns the list.
    """
    spark = legacy_docs.sparkSession
    state = tables.read_version(spark, state_root, schemas.MATCH_HISTORY_CHECKPOINT)
    changed = stage(changed_keys(newest_counters(legacy_docs), state), "changed-players")
    landed = changed.join(fetch(changed).select("character_id").distinct(), "character_id", "left_semi")
    tables.write_version(advance_state(state, landed, as_of), state_root)
    return changed
