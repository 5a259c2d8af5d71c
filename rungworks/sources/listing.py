"""File listings as DataFrames: windows, newest files, backlog, and what is still unread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rungworks.functions import filenames
from rungworks.functions.scalars import moment
from rungworks.operators.latest import first_n_per_key
from rungworks.operators.merge import rows_to_insert

# Fixed value: how many of the newest files per league a window holds, where one is asked for.
DEFAULT_WINDOW = 10

FAMILY = ("kind", "league_id")


def list_files(spark: SparkSession, root: str, glob: str = "*.json") -> DataFrame:
    """Files below ``root``: (file_name, path) and what the names say.

    The binary reader lists without opening files as long as no content is selected.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(root)
        .select(filenames.base_name("path").alias("file_name"), "path")
    )
    return describe(files)


def describe(files: DataFrame) -> DataFrame:
    """Add kind, league and snapshot time read from ``file_name``."""
    return files.withColumns(
        {
            "kind": filenames.kind("file_name"),
            "league_id": filenames.league_id("file_name"),
            "snapshot_ts": filenames.snapshot_ts("file_name"),
        }
    )


def last_files(listing: DataFrame, n: int = DEFAULT_WINDOW) -> DataFrame:
    """The ``n`` newest files of each kind and league, by name."""
    return first_n_per_key(listing, FAMILY, [F.col("file_name").desc()], n)


def latest_file(listing: DataFrame) -> DataFrame:
    """The newest file of each kind and league."""
    return last_files(listing, 1)


def latest_snapshot(docs: DataFrame, partition: str, ts: str = "snapshot_ts") -> DataFrame:
    """Rows of each partition's newest snapshot, however many rows it has."""
    newest = docs.groupBy(partition).agg(F.max(ts).alias(ts))
    return docs.join(newest, [partition, ts], "left_semi")


def backlog(listing: DataFrame, window: int = DEFAULT_WINDOW) -> DataFrame:
    """Per kind and league: files in all, files outside the window, and whether it lags.

    It lags when there are more than two windows of files, processed ones included.
    """
    return (
        listing.groupBy(*FAMILY)
        .agg(F.count("*").alias("total_files"))
        .withColumns(
            {
                "outside_window": F.greatest(F.col("total_files") - window, F.lit(0).cast("bigint")),
                "lagging": F.col("total_files") > 2 * window,
            }
        )
    )


def unprocessed(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger does not hold."""
    return listing.join(ledger.select(F.col("filename").alias("file_name")), "file_name", "left_anti")


def ledger_entries(files: DataFrame, ledger: DataFrame, as_of: str) -> DataFrame:
    """New ledger rows for ``files``; a file already noted is not noted again."""
    noted = files.select(F.col("file_name").alias("filename"), moment(as_of).alias("processed_at"))
    return rows_to_insert(ledger, noted, ["filename"])
