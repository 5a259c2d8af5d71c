"""Tables as Parquet folders.

Tables with a time column are kept in one folder per day.  Inserts add files;
merges replace the folders of the days they touch, so their cost follows the batch
and not the table.  The new days are first written whole, beside the table, and that they
are complete is the record of the intent: from then on readers take those days from there, and
the next writer moves what a writer that died has not moved.  A table has one writer at a time.
Small tables that a merge rewrites whole are kept as numbered
versions: a merge reads the newest complete version and writes the next, so a job
that dies half-way leaves the last good one in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rungworks.schemas import Table
from rungworks.session import stage

DAY = "day"
#: Folder of a table, unseen by Spark, in which new days wait until they take their place.
_REPLACING = "_replacing"
LISTING_TASKS = 32


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _few_listing_tasks(spark: SparkSession):
    """Day folders are listed by a few tasks, many folders each, instead of by a task per folder."""
    return _setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(LISTING_TASKS))


def _spread_days(spark: SparkSession):
    """Small days are not gathered into one task, which would write their folders one after another."""
    return _setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false")


def read_table(
    spark: SparkSession,
    path: str,
    table: Table,
    days: Sequence[date] | None = None,
    since: date | None = None,
) -> DataFrame:
    """The table at ``path``, or an empty frame of its schema if nothing was written yet.

    ``days`` and ``since`` pick day folders; the others are not listed as input.
    """
    if not exists(spark, path) or (days is not None and not days):
        return table.empty(spark)
    if not table.time:
        return spark.read.schema(table.schema).parquet(path)
    stored = _days_of(spark, path, table)
    if days is not None:
        stored = stored.where(F.col(DAY).isin(list(days)) if days else F.lit(False))
    if since is not None:
        stored = stored.where(F.col(DAY) >= F.lit(since))
    return stored.select(table.schema.names)


def _days_of(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """All rows with their day; complete new days count in place of those they are about to replace."""
    reader = spark.read.schema(table.schema.add(DAY, "date"))
    with _few_listing_tasks(spark):
        stored = reader.parquet(path)
    for waiting in _complete(spark, path):
        names = [s.getPath().getName() for s in _day_folders(spark, waiting)]
        days = [date.fromisoformat(n.partition("=")[2]) for n in names if not n.endswith(_NO_DAY)]
        kept = ~F.col(DAY).isin(days) if days else F.lit(True)
        stored = stored.where(F.col(DAY).isNotNull() & kept if len(days) < len(names) else F.col(DAY).isNull() | kept)
        if names:
            stored = stored.unionByName(reader.parquet(waiting))
    return stored


_NO_DAY = "=__HIVE_DEFAULT_PARTITION__"


def _waiting(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _folder(spark, f"{path}/{_REPLACING}")
    return sorted(s.getPath().toString() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def _complete(spark: SparkSession, path: str) -> list[str]:
    return [w for w in _waiting(spark, path) if exists(spark, f"{w}/_SUCCESS")]


def _day_folders(spark: SparkSession, waiting: str) -> list:
    fs, folder = _folder(spark, waiting)
    return [s for s in fs.listStatus(folder) if s.getPath().getName().startswith(f"{DAY}=")]


def _move_day(spark: SparkSession, source: str, target: str) -> None:
    """Put a new day in the place of the old one; what is missing after a failure still waits in ``source``."""
    fs, new = _folder(spark, source)
    old = _folder(spark, target)[1]
    fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"{source} could not be moved to {target}")


def finish_replacing(spark: SparkSession, path: str) -> None:
    """Move complete new days into place, older ones first, and drop incomplete ones, which nobody has read.

    For writers only.
    """
    complete = _complete(spark, path)
    for waiting in _waiting(spark, path):
        if waiting in complete:
            for day in _day_folders(spark, waiting):
                _move_day(spark, day.getPath().toString(), f"{path}/{day.getPath().getName()}")
        fs, folder = _folder(spark, waiting)
        fs.delete(folder, True)


def ensure_table(spark: SparkSession, path: str, table: Table) -> None:
    """Write the empty table if there is none; does nothing otherwise."""
    if not exists(spark, path):
        append(table.empty(spark), path, table)


def touched_days(df: DataFrame, time: str) -> list[date]:
    """The days in a time column: one value per day reaches the driver."""
    found = df.select(F.to_date(time).alias(DAY)).where(F.col(DAY).isNotNull()).distinct()
    return sorted(r[DAY] for r in found.collect())


def _by_day(df: DataFrame, table: Table) -> DataFrame:
    """Rows with their day, laid out so that a day is written by few but enough tasks."""
    return df.withColumn(DAY, F.to_date(table.time)).hint("rebalance", DAY)


def append(df: DataFrame, path: str, table: Table) -> None:
    df = df.select(table.schema.names)
    if _complete(df.sparkSession, path):  # days that wait must not cover what is added now
        df = stage(df, f"append-{table.name}")
        finish_replacing(df.sparkSession, path)
    if table.time:
        with _spread_days(df.sparkSession):
            _by_day(df, table).write.mode("append").partitionBy(DAY).parquet(path)
    else:
        df.write.mode("append").parquet(path)


#: Days that may have got rows, and the number of the change that brought them.
CHANGES = Table("changes", "day DATE, change BIGINT", (), ())


def _changes(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, f"{path}-changes", CHANGES)


def note_days(spark: SparkSession, path: str, days: Sequence[date]) -> None:
    """Note the days of a table that rows are about to be added to, as its next change.

    Before the rows are written: a writer that dies then leaves days noted in vain, which does no
    harm, and notes them again when it is repeated.
    """
    if days:
        change = (_changes(spark, path).agg(F.max("change")).first()[0] or 0) + 1
        noted = spark.createDataFrame([(d, change) for d in days], CHANGES.schema)
        noted.coalesce(1).write.mode("append").parquet(f"{path}-changes")


def changed_days(spark: SparkSession, path: str, since: int) -> dict[date, int]:
    """The days noted after the change ``since``, each with its last change."""
    newer = _changes(spark, path).where(F.col("change") > since)
    return {r["day"]: r["last"] for r in newer.groupBy("day").agg(F.max("change").alias("last")).collect()}


def has_filters(spark: SparkSession, path: str) -> bool:
    """Whether filters speak for all keys of the table: they do from its first rows on, or never."""
    if exists(spark, f"{path}-keys"):
        return True
    return not exists(spark, path) or not (_day_folders(spark, path) or _waiting(spark, path))


def replace_days(df: DataFrame, path: str, table: Table) -> None:
    """Replace the day folders that ``df`` has rows in.

    ``df`` may be computed from the very files that are replaced.  A run that dies leaves the
    old table or the new one, never a part: see :func:`finish_replacing`.
    """
    spark = df.sparkSession
    before = _waiting(spark, path)
    number = 1 + max((int(w.rsplit("/", 1)[1].partition("-")[0]) for w in before), default=0)
    waiting = f"{path}/{_REPLACING}/{number:06d}-{uuid.uuid4().hex}"
    with _spread_days(spark):
        _by_day(df.select(table.schema.names), table).write.partitionBy(DAY).parquet(waiting)
    finish_replacing(spark, path)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    fs, folder = _folder(spark, root)
    if not fs.exists(folder):
        return []
    numbers = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v") and name[1:].isdigit() and exists(spark, f"{root}/{name}/_SUCCESS"):
            numbers.append(int(name[1:]))
    return sorted(numbers)


def read_version(spark: SparkSession, root: str, table: Table, below: int | None = None) -> DataFrame:
    """The newest complete version (of a number less than ``below``), or an empty frame."""
    known = [n for n in versions(spark, root) if below is None or n < below]
    if not known:
        return table.empty(spark)
    return spark.read.schema(table.schema).parquet(_version(root, known[-1]))


def _version(root: str, number: int) -> str:
    return f"{root}/v{number:06d}"


def write_version(df: DataFrame, root: str, number: int | None = None, keep: int = 3) -> str:
    """Write the next version, or that ``number``; what is there of that number is written over.

    Of the versions up to it the newest ``keep`` stay.
    """
    spark = df.sparkSession
    known = versions(spark, root)
    if number is None:
        number = (known[-1] if known else 0) + 1
    path = _version(root, number)
    df.write.mode("overwrite").parquet(path)
    for old in [n for n in known if n < number][: 1 - keep or None]:
        fs, folder = _folder(spark, _version(root, old))
        fs.delete(folder, True)
    return path


def first_version(spark: SparkSession, root: str, checkpoint: str) -> int:
    """The version that batch 0 of a stream writes: the next one when the stream began.

    It is noted in the stream's checkpoint folder, so it goes when the checkpoint goes.
    """
    fs, folder = _folder(spark, f"{checkpoint}/first-version")
    if fs.exists(folder):
        return int(fs.listStatus(folder)[0].getPath().getName())
    known = versions(spark, root)
    first = (known[-1] if known else 0) + 1
    fs.mkdirs(_folder(spark, f"{checkpoint}/first-version/{first}")[1])
    return first
