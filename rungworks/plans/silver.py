"""Documents to typed tables: one spec per kind of document, one way to load them all."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from rungworks import schemas
from rungworks.functions.scalars import moment
from rungworks.operators import flatten, keyfilter
from rungworks.operators.contracts import row_violation, split
from rungworks.operators.merge import rows_to_insert
from rungworks.session import stage, staging
from rungworks.sources import listing, tables
from rungworks.sources.documents import read_documents


@dataclass(frozen=True)
class Flow:
    """A kind of document, how it is flattened, and the table it feeds."""

    kind: str
    document: str
    transform: Callable[[DataFrame], DataFrame]
    table: schemas.Table


# The kinds of document as their file names spell them.
LEAGUE = Flow(
    "league_raw",
    schemas.LEAGUE_DOCUMENT,
    flatten.league_divisions,
    schemas.LEAGUE_DIVISIONS,
)
MODERN = Flow(
    "modern_ladders_raw",
    schemas.MODERN_LADDER_DOCUMENT,
    flatten.modern_ladder_teams,
    schemas.MODERN_LADDER_TEAMS,
)
LEGACY = Flow(
    "legacy_ladders_raw",
    schemas.LEGACY_LADDER_DOCUMENT,
    flatten.legacy_ladder_members,
    schemas.LEGACY_LADDER_MEMBERS,
)
MATCHES = Flow(
    "matches_all_history",
    schemas.MATCH_HISTORY_DOCUMENT,
    flatten.match_history,
    schemas.MATCH_HISTORY,
)
FLOWS = (LEAGUE, MODERN, LEGACY, MATCHES)


def checked_rows(flow: Flow, docs: DataFrame) -> DataFrame:
    """Flattened rows with a ``violation`` column, null for rows fit for the table.

    Rows without the parts of the key that make them meaningful are left out, as
    for players the source reports without an id.
    """
    rows = docs.transform(flow.transform)
    if flow.table.drop_if_null:
        rows = rows.dropna(subset=list(flow.table.drop_if_null))
    return row_violation(rows, flow.table)


def prepare(flow: Flow, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows fit for the table, in its types; quarantined rows)."""
    sound, broken = split(checked_rows(flow, docs))
    return flow.table.conform(sound), broken


def set_aside(rows: DataFrame, source: str, violation: Column, columns: list[str], silver: str, as_of: str) -> None:
    """Put rows into the quarantine table as text, each text of a source once.

    So a replayed batch adds nothing.
    """
    spark, table = rows.sparkSession, schemas.QUARANTINE
    aside = rows.select(
        F.lit(source).alias("source"),
        violation.alias("violation"),
        F.to_json(F.struct(*columns)).alias("content"),
        moment(as_of).alias("loaded_at"),
    )
    path = f"{silver}/{table.name}"
    held = tables.read_table(spark, path, table)
    tables.append(rows_to_insert(held, aside, ["source", "violation", "content"]), path, table)


def load(flow: Flow, docs: DataFrame, silver: str, as_of: str) -> tuple[int, int]:
    """Insert the sound rows of ``docs`` whose key the table lacks: (processed, inserted).

    The documents are parsed once, into a staged table, and so are the rows to insert;
    both are counted while they are written, in the last stage of their job, so that work
    done again counts once.  Only days that may hold a key of the batch are read, by the
    Bloom filters of the table's keys, and of those only the keys.  Filters are written before
    the rows they speak of: a load that dies leaves a filter that reports too much, never too
    little.  Rows get into a table with filters by this function only; a table that had
    rows before it had filters does without.  Broken rows go to the quarantine table, as text.
    """
    spark, table = docs.sparkSession, flow.table
    path = f"{silver}/{table.name}"
    with staging(spark):
        rows = F.count(F.lit(1)).alias("rows")
        came, went = Observation(), Observation()
        checked = checked_rows(flow, docs).observe(came, rows, F.count("violation").alias("broken"))
        sound, aside = split(stage(checked, f"load-{table.name}"))
        broken = came.get["broken"]
        sound = table.conform(sound)
        days = tables.touched_days(sound, table.time)
        filtered = tables.has_filters(spark, path)
        may_hold = days
        if filtered:
            filters = tables.read_table(spark, f"{path}-keys", keyfilter.FILTERS).where(F.col("day").isin(days))
            may_hold = tables.touched_days(keyfilter.possibly_held(sound, filters, table.time, table.key), "day")
        target = tables.read_table(spark, path, table, may_hold)
        new = rows_to_insert(target, sound, table.key).withColumn(table.audit, moment(as_of))
        fresh = stage(new.observe(went, rows), f"new-{table.name}")
        inserted = went.get["rows"]
        if inserted:
            if filtered:
                built = keyfilter.build(fresh, table.time, table.key)
                tables.append(built, f"{path}-keys", keyfilter.FILTERS)
            tables.note_days(spark, path, days)
            tables.append(fresh, path, table)
        if broken:
            set_aside(aside, table.name, F.col("violation"), table.payload, silver, as_of)
    return came.get["rows"] - broken, inserted


SUMMARY = "processed BIGINT, inserted BIGINT, skipped BIGINT, outside_window BIGINT, lagging BOOLEAN"


def ingest_window(
    spark: SparkSession,
    flow: Flow,
    bronze: str,
    silver: str,
    as_of: str,
    window: int | None = None,
    files_at_once: int = 1000,
) -> DataFrame:
    """Load all pending files, or those among the newest ``window`` per league.

    Returns the load summary: rows processed, inserted and skipped, pending files that the
    window left out, and whether a league lags behind it.  Files are worked off in slices,
    oldest first, so that the driver handles at most ``files_at_once`` names at a time.  The
    ledger is written after each slice; a run that dies is simply repeated.
    """
    ledger_path = f"{silver}/{schemas.PROCESSED_FILES.name}"
    with staging(spark):
        files = stage(listing.list_files(spark, bronze, f"{flow.kind}_*.json"), "listed-files")
        ledger = tables.read_table(spark, ledger_path, schemas.PROCESSED_FILES)
        chosen = files if window is None else listing.last_files(files, window)
        pending = stage(listing.unprocessed(chosen, ledger).select("file_name", "path"), "pending-files")
        processed = inserted = left = 0
        lagging = False
        # Sorted names reach the driver a partition at a time, and are let go a slice at a time.
        for names in _slices(pending.orderBy("file_name").toLocalIterator(), files_at_once):
            docs = read_documents(spark, [r["path"] for r in names], flow.document)
            came, went = load(flow, docs, silver, as_of)
            processed, inserted = processed + came, inserted + went
            done = spark.createDataFrame([(r["file_name"],) for r in names], "file_name STRING")
            tables.append(listing.ledger_entries(done, ledger, as_of), ledger_path, schemas.PROCESSED_FILES)
        if window is not None:
            handled = pending.select(F.col("file_name").alias("filename"))
            left = listing.unprocessed(listing.unprocessed(files, ledger), handled).count()
            lagging = not listing.backlog(files, window).where("lagging").isEmpty()
    return spark.createDataFrame([(processed, inserted, processed - inserted, left, lagging)], SUMMARY)


def _slices(rows: Iterator[Row], size: int) -> Iterator[list[Row]]:
    while taken := list(islice(rows, size)):
        yield taken


def ingest_all(
    spark: SparkSession, bronze: str, silver: str, as_of: str, window: int | None = None
) -> dict[str, DataFrame]:
    """All four flows, one after the other; they share nothing but the ledger."""
    return {f.table.name: ingest_window(spark, f, bronze, silver, as_of, window) for f in FLOWS}
